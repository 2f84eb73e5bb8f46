"""Compressed event logs against streams that Spark's own codecs wrote."""
from __future__ import annotations

import io
import json
import random

import pytest

from adlake.sources.codecs import OPENERS, lzf_block
from adlake.sources.eventlog import read_event_log

CODECS = {".zstd": "ZStdCompressionCodec", ".lz4": "LZ4CompressionCodec", ".snappy": "SnappyCompressionCodec", ".lzf": "LZFCompressionCodec"}


def packed(spark, ending: str, *parts: bytes) -> bytes:
    jvm = spark._jvm
    codec = getattr(jvm.org.apache.spark.io, CODECS[ending])(spark.sparkContext._jsc.sc().conf())
    out = jvm.java.io.ByteArrayOutputStream()
    stream = codec.compressedOutputStream(out)
    for part in parts:
        stream.write(bytearray(part))
        stream.flush()
    stream.close()
    return bytes(out.toByteArray())


def samples():
    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcdef \n", k=rng.randrange(1, 9))) for _ in range(50)]
    return [b"", b"x", b"a" * 100_000, rng.randbytes(70_000), b"".join(rng.choices(words, k=60_000)), json.dumps({"é": [1] * 5000}).encode()]


@pytest.mark.parametrize("ending", OPENERS)
def test_streams_of_sparks_codecs(spark, ending):
    for data in samples():
        stream = packed(spark, ending, data[:len(data) // 3], data[len(data) // 3:])
        assert OPENERS[ending](io.BytesIO(stream)).read() == data
        assert OPENERS[ending](io.BytesIO(stream + packed(spark, ending, b"more"))).read() == data + b"more"


@pytest.mark.parametrize("ending", [".lz4", ".snappy", ".lzf"])
def test_torn_and_foreign_streams_raise(spark, ending):
    stream = packed(spark, ending, samples()[4])
    for cut in (len(stream) // 2, len(stream) - 30 if ending == ".lz4" else len(stream) - 1):
        with pytest.raises((EOFError, ValueError)):
            OPENERS[ending](io.BytesIO(stream[:cut])).read()
    with pytest.raises((EOFError, ValueError)):
        OPENERS[ending](io.BytesIO(b"plain text, no such stream")).read()


def test_lzf_copies_that_run_into_themselves():
    assert lzf_block(bytes([2]) + b"abc" + bytes([(4 << 5), 2]), 9) == b"abcabcabc"
    assert lzf_block(bytes([0]) + b"z" + bytes([(7 << 5), 10, 0]), 20) == b"z" * 20
    with pytest.raises(ValueError):
        lzf_block(bytes([0]) + b"z" + bytes([(1 << 5), 9]), 4)


def test_the_same_events_from_every_form(spark, tmp_path):
    events = [json.dumps({"Event": "SparkListenerTaskEnd", "Stage ID": k, "text": "é " * (k % 40)}, ensure_ascii=False) for k in range(12_000)]
    text = "".join(e + "\n" for e in events).encode()
    found = {}
    for ending in ("", *OPENERS):
        folder = tmp_path / f"form{ending}"
        folder.mkdir()
        (folder / f"app-1{ending}").write_bytes(packed(spark, ending, text) if ending else text)
        log = read_event_log(spark, str(folder))
        found[ending] = [(r.application, r.event, r.json) for r in log.orderBy("seq").collect()]
    assert [j for _, _, j in found[""]] == events and {a for a, _, _ in found[""]} == {"app-1"}
    assert all(rows == found[""] for rows in found.values())


def test_forms_side_by_side(spark, tmp_path):
    """Rolled and single logs of several applications, each in a form of its own."""
    line = json.dumps({"Event": "SparkListenerStageSubmitted"}) + "\n"
    for k, ending in enumerate(("", *OPENERS)):
        rolled = tmp_path / f"eventlog_v2_app-{k}"
        rolled.mkdir()
        for n in (1, 2):
            data = (line * (k + n)).encode()
            (rolled / f"events_{n}_app-{k}{ending}").write_bytes(packed(spark, ending, data) if ending else data)
        (rolled / f"appstatus_app-{k}").write_bytes(b"")
    counts = {r.application: r["count"] for r in read_event_log(spark, str(tmp_path)).groupBy("application").count().collect()}
    assert counts == {f"app-{k}": 2 * k + 3 for k in range(5)}
