"""Operator 13: n-gram Jaccard join by a blocked sparse matrix product.

Rows of the matrix are the distinct sets of ``width``-word shingles (equal sets are one row, a
class), columns are shingles, named by 64-bit hashes. Only pairs whose product can reach the
threshold are ever multiplied, and the product of a pair is accumulated over blocks of
columns and given up as soon as the columns left can't lift it to the bound that the two
sizes set.

1. Prefix columns. In any order of the columns, a set of n that reaches the threshold with another shares
   one of its first n - ceil(0.8 n) + 1 columns with it. The order is by hash, frequent columns (in the prefixes
   of more than FREQUENT documents) last, so a passage that many documents share brings nobody
   together unless it is nearly all they have. The classes that share a prefix column are a list; lists of the
   same classes, which near copies have by the dozen, are one.
2. Each list's smallest class is paired with the others, deduplicated over lists. A pair
   goes on only if its sizes allow it and if the parities of its hashed columns differ in no more bits
   than the sizes allow the sets to differ (an upper bound, so nothing is lost): first of 512 bits,
   then of some bits per shingle.
3. Whole sets are fetched for those pairs alone, multiplied, and the links' components are found.
4. A list whose classes are in one component by now is done and not read again. In the others, blocks of classes
   meet block by block, and pairs of different components are filtered as above, each pair once: first, in two rounds, the
   few nearest to each class, which are likely links and join most of a group, then all that is left.

So a group of near copies costs a few rows per member, not a row per pair, and no link that
could join two components is left out. Hot columns are found by exact counts; what reaches
every worker are bitmaps of a fixed size (a set bit that stands for two columns only makes
work). Sets, lists, links and components stay in tables, which are deleted, like the files of the shuffles that made
them, once nothing reads them. Results do not depend on the constants.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from adlake.llm.common import discard, fresh, materialize, refuse_clashes, slices, text_column
from adlake.llm.components import components
from adlake.session import conf_scope

WIDTH, PERCENT = 5, 80
#: A column in more prefixes than FREQUENT is put last; classes of a block; candidates of a class in the first rounds,
#: before which comes one of lists' smallest classes alone.
FREQUENT, BLOCK_ROWS, NEAREST, STARS = 64, 1024, (2, 2), 0
#: Bits of the bitmaps that workers hold (8 MB), parity bits per shingle and of a first look, blocks of columns.
BITMAP_BITS, PARITY, COARSE, COLUMN_BLOCKS = 26, 4, 512, 8
#: Sets a task remembers, so that copies within it bring their columns once.
SEEN = 200_000
#: Shuffle files go when the step that wrote them has its table; without it they stay as long as the driver's heap has room.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: Words whose hashes a worker remembers, about 150 bytes each.
WORDS = 300_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # any odd numbers serve


_WORDS: dict[bytes, bytes] = {}


def _digests(words: list[bytes]) -> list[bytes]:
    """The words' 64-bit hashes; each distinct word is hashed once per worker, as long as WORDS are enough."""
    try:
        return [_WORDS[w] for w in words]
    except KeyError:
        for w in words:
            if w not in _WORDS:
                if len(_WORDS) >= WORDS:
                    _WORDS.clear()
                _WORDS[w] = xxhash.xxh64_digest(w)
        return [_WORDS[w] if w in _WORDS else xxhash.xxh64_digest(w) for w in words]


def shingle_set(text: bytes, width: int = WIDTH) -> np.ndarray:
    """Hashes of the distinct shingles in order; of the whole word sequence if that is shorter."""
    words = np.frombuffer(b"".join(_digests(text.translate(_LOWER).split())), dtype="<u8")
    width = min(width, len(words))
    if not width:
        return np.zeros(0, np.int64)
    count = len(words) - width + 1
    h = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        h = h * _ODD + words[k:k + count]
    h = (h ^ (h >> np.uint64(32))) * _MIX
    columns = np.sort((h ^ (h >> np.uint64(29))).view(np.int64))
    return columns[np.r_[True, columns[1:] != columns[:-1]]]


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def parity(columns: np.ndarray) -> bytes:
    """Bit i is the parity of how many columns hash to i; a power of two of bits, at least PARITY per column."""
    bits = max(64, 1 << (PARITY * len(columns) - 1).bit_length())
    return np.packbits(np.bincount(columns & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def coarse(columns: np.ndarray) -> bytes:
    """The same for COARSE bits, whatever the number of columns."""
    return np.packbits(np.bincount(columns & (COARSE - 1), minlength=COARSE).astype(np.uint8) & 1, bitorder="little").tobytes()


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """Differing bits of two parity rows, the longer one folded to the shorter one's length."""
    while len(a) != len(b):
        if len(a) > len(b):
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        else:
            b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


class Bitmap:
    """A set of 64-bit numbers by their low bits; may hold numbers that were never put in."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.int64(64 * len(words) - 1)

    def __contains__(self, x: int) -> bool:
        return bool(self.of(np.array([x], dtype=np.int64))[0])

    def of(self, x: np.ndarray) -> np.ndarray:
        low = x & self.mask
        return ((self.words[low >> 6] >> (low & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def bitmap(df: DataFrame, column: str, bits: int = BITMAP_BITS):
    """Broadcast bitmap of a column; at most 2**(bits - 6) rows reach the driver."""
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = df.select(F.shiftright(low, 6).alias("word"), F.expr(f"shiftleft(1L, cast({column} & 63 AS int))").alias("bit"))
    found = rows.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    words = np.zeros(1 << (bits - 6), dtype=np.int64)
    words[found.column("word").to_numpy()] = found.column("bit").to_numpy()
    return df.sparkSession.sparkContext.broadcast(Bitmap(words.view(np.uint64)))


def _each_set(docs: DataFrame, text_col: str, width: int, emit: Callable, schema: str | T.StructType, only=None) -> DataFrame:
    """Run ``emit(part, sets, keys, new, texts)`` on slices of ``docs``: the rows' sets, their 128-bit keys as two
    columns of numbers, which rows bring a set that the task has not just had, and the texts' keys. Texts whose keys
    the bitmap ``only`` doesn't have are left out unread."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for part in slices(batches, text_col):
            column = part.column(text_col).cast(pa.binary()).to_pylist()
            texts = np.array([xxhash.xxh3_64_intdigest(t) for t in column], dtype=np.uint64).view(np.int64)
            if only is not None:
                use = only.value.of(texts)
                part, texts = part.filter(pa.array(use)), texts[use]
                column = [t for t, u in zip(column, use) if u]
                if not column:
                    continue
            sets = [shingle_set(t, width) for t in column]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            new = np.zeros(len(sets), dtype=bool)
            for k, digest in enumerate(digests):
                if digest not in seen and len(sets[k]):
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(digest)
                    new[k] = True
            keys = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield from emit(part.drop_columns([text_col]), sets, keys, new, texts)

    return docs.mapInArrow(run, schema)


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    return pa.array(values, pa.list_(pa.int64()))


def _summaries(source: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows with n, their set's and text's keys, and (on the first of a task's copies) prefix and parity."""
    def emit(part, sets, keys, new, texts):
        prefixes = [s[:prefix_size(len(s), percent)] if first else None for s, first in zip(sets, new)]
        columns = {"__n": pa.array([len(s) for s in sets], pa.int64()), "__k1": pa.array(keys[:, 0]), "__k2": pa.array(keys[:, 1]),
                   "__t": pa.array(texts), "__prefix": _lists(prefixes), "__parity": pa.array([parity(s) if first else None for s, first in zip(sets, new)], pa.binary()),
                   "__coarse": pa.array([coarse(s) if first else None for s, first in zip(sets, new)], pa.binary())}
        for name, values in columns.items():
            part = part.append_column(name, values)
        yield from (part.slice(k, 512) for k in range(0, part.num_rows, 512))

    kept = [f for f in source.schema.fields if f.name != "__text"]
    more = "__n long, __k1 long, __k2 long, __t long, __prefix array<long>, __parity binary, __coarse binary"
    return _each_set(source, "__text", width, emit, T.StructType([*kept, *T.StructType.fromDDL(more).fields]))


def _texts_of_late(first: DataFrame, frequent) -> DataFrame:
    """Text keys of the sets with a frequent column in their prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.repeat(np.arange(batch.num_rows), batch.column("prefix").value_lengths().to_numpy())
            late = np.unique(at[frequent.value.of(batch.column("prefix").flatten().to_numpy())])
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("t").to_numpy()[late])], names=["t"])

    return first.select("prefix", "t").mapInArrow(run, "t long")


def _late_prefixes(texts: DataFrame, width: int, percent: int, frequent, only) -> DataFrame:
    """(k1, k2, n, prefix, added) of sets with a frequent column among their first ones. With those columns put last,
    their first ones are the frequent-free rest of the old first ones and ``prefix``; ``added`` are those of it that were
    not among the first ones before."""
    def emit(part, sets, keys, new, texts):
        rows = []
        for s, key, first in zip(sets, keys.tolist(), new):
            size = prefix_size(len(s), percent)
            if first and frequent.value.of(s[:size]).any():
                late = frequent.value.of(s)
                prefix = np.concatenate([s[~late], s[late]])[np.count_nonzero(~late[:size]):size]
                rows.append((*key, len(s), prefix, prefix[prefix > s[size - 1]]))
        if rows:
            k1, k2, n, prefix, added = zip(*rows)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (k1, k2, n)), _lists(list(prefix)), _lists(list(added))],
                                             names=["k1", "k2", "n", "prefix", "added"])

    return _each_set(texts, "__text", width, emit, "k1 long, k2 long, n long, prefix array<long>, added array<long>", only)


def _columns_in(held: DataFrame, prefix: str, columns) -> DataFrame:
    """The columns of all prefixes that a bitmap has, one row each time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(found[columns.value.of(found)])], names=["column"])

    return held.select(prefix).mapInArrow(run, "column long")


def _entries(held: DataFrame, shared, frequent=None) -> DataFrame:
    """(column, k1, k2, n) of the prefixes, as far as their columns are shared and not ``frequent``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.repeat(np.arange(batch.num_rows), batch.column("prefix").value_lengths().to_numpy())
            column = batch.column("prefix").flatten().to_numpy()
            use = shared.value.of(column)
            if frequent is not None:
                use &= ~frequent.value.of(column)
            own = [pa.array(batch.column(c).to_numpy()[at[use]]) for c in ("k1", "k2", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(column[use]), *own], names=["column", "k1", "k2", "n"])

    return held.select("prefix", "k1", "k2", "n").mapInArrow(run, "column long, k1 long, k2 long, n long")


def _possible(a, b, percent: int):
    """Whether sets of these sizes can reach the threshold at all."""
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def products(a: list[np.ndarray], b: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which pairs of rows a[i], b[i] reach the threshold: sparse products, block of columns by block."""
    na, nb = (np.array([len(s) for s in side], dtype=np.int64) for side in (a, b))
    need, got = percent * (na + nb), np.zeros(len(a), np.int64)  # got * (100 + percent) must reach need
    left_a, left_b, alive = na.copy(), nb.copy(), np.ones(len(a), dtype=bool)
    edges = np.linspace(-2.0 ** 63, 2.0 ** 63, COLUMN_BLOCKS + 1)[1:-1].astype(np.int64)
    cut_a, cut_b = ([np.r_[0, np.searchsorted(s, edges), len(s)] for s in side] for side in (a, b))
    for block in range(COLUMN_BLOCKS):
        alive &= (100 + percent) * (got + np.minimum(left_a, left_b)) >= need
        rows = np.flatnonzero(alive)
        if not len(rows):
            break
        parts = [[s[r][cut[r][block]:cut[r][block + 1]] for r in rows] for s, cut in ((a, cut_a), (b, cut_b))]
        sizes = [np.array([len(p) for p in side]) for side in parts]
        row = [np.repeat(np.arange(len(rows)), n) for n in sizes]
        columns, place = np.unique(np.concatenate([*parts[0], *parts[1]]), return_inverse=True)
        cell = np.concatenate(row) * max(len(columns), 1) + place
        both = np.intersect1d(cell[:sizes[0].sum()], cell[sizes[0].sum():], assume_unique=True)
        got[rows] += np.bincount(both // max(len(columns), 1), minlength=len(rows))
        left_a[rows] -= sizes[0]
        left_b[rows] -= sizes[1]
    return (100 + percent) * got >= need


class _Join:
    """The tables of one join, on which rounds of pairs are tried."""

    def __init__(self, rows: DataFrame, texts: DataFrame, width: int, percent: int, frequent_rows: int, block_rows: int):
        self.texts, self.width, self.percent, self.block_rows = texts, width, percent, block_rows
        best = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("__uid").alias("uid"))
        self.classes = materialize(rows.filter("__n > 0").groupBy(F.col("__k1").alias("k1"), F.col("__k2").alias("k2")).agg(
            F.min(best).alias("best"), F.min("__t").alias("t")).withColumn("cid", F.col("best.uid")), "jaccard-classes")
        first = rows.filter("__prefix IS NOT NULL").select(F.col("__prefix").alias("prefix"), F.col("__k1").alias("k1"),
                                                           F.col("__k2").alias("k2"), F.col("__n").alias("n"), F.col("__t").alias("t"))
        counts = materialize(first.select(F.explode("prefix").alias("column")).groupBy("column").count().filter("count > 1"),
                             "jaccard-columns")
        frequent = bitmap(counts.filter(F.col("count") > frequent_rows), "column")
        only = bitmap(_texts_of_late(first, frequent), "t")
        late = materialize(_late_prefixes(texts, width, percent, frequent, only), "jaccard-late")
        # a column that late prefixes added is shared if two of them added it, or if it was a first one elsewhere
        added = late.select(F.explode("added").alias("column"))
        again = added.unionByName(_columns_in(first, "prefix", bitmap(added, "column"))).groupBy("column").count().filter("count > 1")
        shared = bitmap(counts.select("column").unionByName(again.select("column")), "column")
        discard(counts)
        entries = materialize(_entries(first, shared, frequent).unionByName(_entries(late, shared)).join(
            self.classes.select("k1", "k2", "cid"), ["k1", "k2"]).select("column", "cid", "n").distinct(), "jaccard-entries")
        discard(late)
        lists = entries.groupBy("column").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("members"),
                                              F.min(F.struct("n", "cid")).alias("top")).filter("m > 1")
        lists = lists.groupBy("m", "members").agg(F.min(F.struct("column", "top")).alias("list")).select("list.column", "m", "list.top")
        #: (column, cid, n) with the m members of the column's list and the smallest of them, ``top``
        self.entries = materialize(entries.join(lists, "column"), "jaccard-lists")
        discard(entries)
        listed = self.classes.select("cid", "k1", "k2").join(self.entries.select("cid").distinct(), "cid")
        parities = rows.filter("__parity IS NOT NULL").select(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), "__coarse", "__parity")
        self.parities = materialize(parities.join(listed, ["k1", "k2"]).groupBy("cid").agg(
            F.first("__coarse").alias("__coarse"), F.first("__parity").alias("__parity")), "jaccard-parities")
        self.open = self.entries.filter("m > 2").select("column", "cid", "n", "m")  # a list of two is decided by its star
        self.tried: DataFrame | None = None

    def _whole_sets(self, wanted: DataFrame) -> DataFrame:
        """(cid, columns): the whole sets of the wanted classes, computed from the texts again."""
        keys = materialize(wanted.join(self.classes.select("cid", "k1", "k2", "t"), "cid"), "jaccard-wanted")

        def emit(part, sets, keys, new, texts):
            use = np.flatnonzero(new)
            for at in range(0, len(use), 256):
                k = use[at:at + 256]
                yield pa.RecordBatch.from_arrays([pa.array(keys[k, 0]), pa.array(keys[k, 1]), _lists([sets[i] for i in k])],
                                                 names=["k1", "k2", "columns"])

        found = _each_set(self.texts, "__text", self.width, emit, "k1 long, k2 long, columns array<long>", bitmap(keys, "t"))
        return found.join(keys.drop("t"), ["k1", "k2"]).groupBy("cid").agg(F.first("columns").alias("columns"))

    def _multiplied(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links."""
        percent = self.percent
        both = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
        sets = materialize(self._whole_sets(both), "jaccard-sets")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    a, b = ([v.values.to_numpy() for v in part.column(c)] for c in ("x", "y"))
                    yield part.select(["a", "b"]).filter(pa.array(products(a, b, percent)))

        left = pairs.join(sets.select(F.col("cid").alias("a"), F.col("columns").alias("x")), "a")
        full = left.join(sets.select(F.col("cid").alias("b"), F.col("columns").alias("y")), "b")
        links = materialize(full.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "jaccard-links")
        discard(sets)
        return links

    def star_links(self) -> DataFrame | None:
        """Links between each list's smallest class and its others."""
        others = self.entries.filter("cid != top.cid").filter(_possible(F.col("n"), F.col("top.n"), self.percent))
        pairs = others.select(F.least("top.cid", "cid").alias("a"), F.greatest("top.cid", "cid").alias("b"), (F.col("top.n") + F.col("n")).alias("size"))
        return self._links(self._near(materialize(pairs.distinct(), "jaccard-stars"), "__coarse"))

    def _near(self, pairs: DataFrame, column: str) -> DataFrame:
        """The pairs (a, b, size: summed) whose parities in ``column`` differ in no more bits than links may."""
        percent = self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
                limit = _may_differ(batch.column("size").to_numpy(), percent).tolist()
                near = [differing(np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)) <= k for p, q, k in zip(x, y, limit)]
                yield batch.select(["a", "b", "size"]).filter(pa.array(near, pa.bool_()))

        left = pairs.join(self.parities.select(F.col("cid").alias("a"), F.col(column).alias("x")), "a")
        full = left.join(self.parities.select(F.col("cid").alias("b"), F.col(column).alias("y")), "b")
        return materialize(full.select("a", "b", "size", "x", "y").mapInArrow(run, "a long, b long, size long"), "jaccard-near")

    def _links(self, pairs: DataFrame) -> DataFrame | None:
        """The links (a, b) among pairs that passed the first look; they are not looked at again. None if all fail the second."""
        seen = pairs.select("a", "b")
        self.tried = seen if self.tried is None else self.tried.unionByName(seen)
        near = self._near(pairs, "__parity")
        return None if near.isEmpty() else self._multiplied(near.select("a", "b"))

    def open_links(self, roots: DataFrame, nearest: int | None) -> DataFrame | None:
        """Links between components within lists that still hold several; each class's ``nearest`` candidates
        in a block, or all. None if no list is open, or nothing in them is left to try."""
        percent, rows = self.percent, self.block_rows
        named = self.open.select("column", "cid", "n", "m").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "root", F.coalesce("root", "cid"))
        lists = named.groupBy("column").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high").select("column")
        before, self.open = self.open, materialize(named.join(lists, "column"), "jaccard-open")
        discard(before)
        if self.open.isEmpty():
            return None
        dealt = self.open.withColumn("parts", F.ceil(F.col("m") / rows).cast("int"))
        part = F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")
        others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, part).alias("i"), F.greatest(o, part).alias("j")))
        alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
        meets = F.when(F.col("parts") == 1, alone).otherwise(F.filter(others, lambda c: c["i"] != c["j"]))
        cells = dealt.select("column", F.explode(meets).alias("c"), "cid", "n", "root").join(self.parities.select("cid", "__coarse"), "cid").select(
            "column", "c.i", "c.j", "cid", "n", "root", "__coarse")
        together = cells.repartition("column", "i", "j").sortWithinPartitions("column", "i", "j")
        near = together.mapInArrow(lambda batches: _near_in_blocks(batches, percent, nearest), "a long, b long, size long")
        near = materialize(near.distinct().join(self.tried, ["a", "b"], "left_anti"), "jaccard-near")
        return None if near.isEmpty() else self._links(near)


def _may_differ(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Most elements that sets of these summed sizes may differ in and still reach the threshold."""
    return (100 - percent) * sizes // (100 + percent)


def _near_in_blocks(batches: Iterator[pa.RecordBatch], percent: int, nearest: int | None) -> Iterator[pa.RecordBatch]:
    """Rows with equal (column, i, j) together -> near pairs of different components in each such block."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        if not rows.num_rows:
            continue
        block = _blocks_of(rows)
        last = int(np.searchsorted(block, block[-1]))
        if last:
            yield from _near_pairs(rows.slice(0, last), block[:last], percent, nearest)
        held = rows.slice(last)
    if held is not None and held.num_rows:
        yield from _near_pairs(held, _blocks_of(held), percent, nearest)


def _blocks_of(rows: pa.Table) -> np.ndarray:
    key = np.array([rows.column(c).to_numpy() for c in ("column", "i", "j")])
    return np.cumsum(np.r_[False, (key[:, 1:] != key[:, :-1]).any(axis=0)])


def _near_pairs(rows: pa.Table, block: np.ndarray, percent: int, nearest: int | None) -> Iterator[pa.RecordBatch]:
    """All blocks at once: each row with the next one of its block by size, then with the one after that, and so on."""
    cid, n, root = (rows.column(c).to_numpy() for c in ("cid", "n", "root"))
    order = np.lexsort((n, block))
    cid, n, root, block = cid[order], n[order], root[order], block[order]
    bits = np.frombuffer(b"".join(rows.column("__coarse").to_pylist()), "<u8").reshape(-1, COARSE // 64)[order]
    largest = 100 * n // percent
    found = []
    open_rows = np.arange(len(n))
    for d in range(1, len(n)):
        open_rows = open_rows[open_rows + d < len(n)]
        # sizes grow within a block, so a row that has met its block's end or a set too large is done
        open_rows = open_rows[(block[open_rows] == block[open_rows + d]) & (n[open_rows + d] <= largest[open_rows])]
        if not len(open_rows):
            break
        k = open_rows[root[open_rows] != root[open_rows + d]]
        for at in range(0, len(k), 1 << 16):
            part = k[at:at + (1 << 16)]
            apart = np.bitwise_count(bits[part] ^ bits[part + d]).sum(axis=1, dtype=np.int64)
            near = apart <= _may_differ(n[part] + n[part + d], percent)
            found.append((part[near], part[near] + d, apart[near]))
    if not found:
        return
    a, b, apart = (np.concatenate(c) for c in zip(*found))
    if nearest is not None and len(a):
        use = np.zeros(len(a), dtype=bool)
        for mine in (a, b):  # a place stands for a class in one block
            by = np.lexsort((apart, mine))
            new = np.r_[True, mine[by][1:] != mine[by][:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
            use[by[np.arange(len(by)) - first < nearest]] = True
        a, b = a[use], b[use]
    x, y = cid[a], cid[b]
    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(n[a] + n[b])], names=["a", "b", "size"])


def _joined(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, carry: tuple[str, ...],
            frequent_rows: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their sets' keys, and (k1, k2, first) of all sets: the first row of the set's component."""
    texts = docs.select(text_column(docs, text_col).alias("__text"))
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), text_column(docs, text_col).alias("__text"),
                         *[docs[f"`{c}`"] for c in carry])
    summaries = materialize(_summaries(source, width, percent).withColumn("__uid", F.monotonically_increasing_id()), "jaccard-rows")
    join = _Join(summaries, texts, width, percent, frequent_rows, block_rows)
    rows = summaries
    if not carry:  # which would be written twice
        rows = materialize(summaries.select("doc_id", "__n", "__k1", "__k2", "__uid"), "jaccard-rows")
        discard(summaries)
    roots = join.classes.select(F.col("cid").alias("node"), F.col("cid").alias("root")).filter("node != root")
    for nearest in (STARS, *NEAREST, None):
        links = join.star_links() if nearest == STARS else join.open_links(roots, nearest)
        if links is not None:  # the components so far stand for the links that made them
            roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    named = join.classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "k1", "k2", F.coalesce("root", "cid").alias("root"), "best")
    firsts = named.groupBy("root").agg(F.min("best").alias("first"))
    owner = materialize(named.join(firsts, "root").select("k1", "k2", "first"), "jaccard-owners")
    discard(join.classes, join.entries, join.parities, join.open, roots)
    return rows, owner


TAKEN = ("doc_id", "n_shingles", "component_id", "kept", "__text", "__n", "__k1", "__k2", "__t", "__prefix", "__parity", "__coarse", "__uid", "k1", "k2", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
                    carry: tuple[str, ...] = (), frequent_rows: int = FREQUENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, then ``carry``.

    Documents link when their sets' intersection is at least ``percent`` percent of their union. component_id is the
    smallest id reachable over links, itself included; one row of each component is kept, one
    with that id. Null texts and texts without words have empty sets and link with nothing, so
    each is a component of its own. Null ids rank after all others, and a component of null ids
    alone has a null component_id. Repeated rows have equal sets and so one component. An empty table
    gives an empty result. ``carry`` columns may not have the result's names."""
    refuse_clashes(carry, TAKEN)
    with conf_scope(docs.sparkSession, CLEANUP):
        rows, owner = _joined(docs, id_col, text_col, width, percent, carry, frequent_rows, block_rows)
    same = (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2")) & (F.col("__n") > 0)
    return rows.join(owner, same, "left").select(
        "doc_id", F.col("__n").alias("n_shingles"), F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce(F.col("__uid") == F.col("first.uid"), F.lit(True)).alias("kept"), *[F.col(f"`{c}`") for c in carry])


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                         percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with their own columns, whatever those
    are named. Nulls, empties, repeats and an empty table are as for ``near_duplicates``."""
    names = {c: fresh(docs, f"__carry_{i}") for i, c in enumerate(docs.columns)}
    inner = docs.select(*[docs[f"`{c}`"].alias(n) for c, n in names.items()])
    marked = near_duplicates(inner, names[id_col], names[text_col], width, percent, tuple(names.values()))
    return marked.filter("kept").select(*[F.col(n).alias(c) for c, n in names.items()])
