"""Byte-level BPE ids of whole texts, fast enough for a corpus.

The vocabulary's splitting pattern never joins text across a space that is followed by
something other than white space. So a text is cut there, each distinct chunk is encoded
once per worker, and ids are looked up afterwards. Ids equal those of the tokenizer file on
the whole text (tested). Chunks of basic and extended Latin characters, on whose classes
all regex libraries agree, use the faster of the two encoders with the same vocabulary.

The file's added tokens (``<|endoftext|>``) are ordinary text to an encoder, or with
``added_tokens`` get their own ids, as the tokenizer file gives them unless told otherwise.
"""
from __future__ import annotations

import base64
import json
import os
import re
from functools import cached_property

import numpy as np

#: Vocabulary files of the public tokenizer package: (tokenizer file, rank file).
VOCABULARY = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")
#: Chunks a worker remembers (about 200 bytes each), and the longest one that it does.
CACHE_CHUNKS, CACHED_CHARS = 300_000, 64
#: The first character after the Latin ones, on whose classes all regex libraries agree.
LATIN_END = "\u0250"
_JOINED = re.compile("  | [\\s\u180e\u200b]| $")
_ENCODERS: dict[tuple[str, str], "Encoder"] = {}


def vocabulary_paths(names: tuple[str, str] = VOCABULARY) -> tuple[str, str]:
    import public_tokenizers
    return tuple(public_tokenizers.path(n) for n in names)


def encoder(names: tuple[str, str] = VOCABULARY) -> "Encoder":
    """This process's encoder."""
    if names not in _ENCODERS:
        _ENCODERS[names] = Encoder(*vocabulary_paths(names))
    return _ENCODERS[names]


class Encoder:
    def __init__(self, tokenizer_path: str, ranks_path: str):
        import public_tokenizers
        import tiktoken
        self.tokenizer_path = tokenizer_path
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.latin = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        self.known: dict[str, bytes] = {}

    @cached_property
    def general(self):
        """The tokenizer file's own encoder, loaded when a text first needs it."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        loaded = Tokenizer.from_file(self.tokenizer_path)
        loaded.encode_special_tokens = True
        return loaded

    def plain(self, chunk: str) -> bytes:
        """The ids of a chunk by one call to an encoder, nothing remembered."""
        if chunk.isascii() or max(chunk) < LATIN_END:
            ids = self.latin(chunk)
        else:
            ids = self.general.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    @cached_property
    def added(self) -> tuple[re.Pattern | None, dict[str, bytes]]:
        """The file's added tokens as a pattern that cuts texts at them, and their ids."""
        with open(self.tokenizer_path, encoding="utf-8") as file:
            tokens = json.load(file)["added_tokens"]
        if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{self.tokenizer_path}: an added token that takes in or depends on the text around it")
        ids = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in tokens}
        longest = sorted(ids, key=len, reverse=True)
        return re.compile(f"({'|'.join(map(re.escape, longest))})") if ids else None, ids

    def __call__(self, text: str, added_tokens: bool = False) -> bytes:
        """The text's ids, little-endian unsigned 32-bit."""
        if added_tokens and self.added[0] and self.added[0].search(text):
            pattern, ids = self.added
            return b"".join(ids[part] if k % 2 else self._ordinary(part) for k, part in enumerate(pattern.split(text)) if part)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if _JOINED.search(text):
            rest, parts = [], rest
            for part in parts:
                if part and not part[0].isspace() and part[0] not in "\u180e\u200b":
                    rest.append(part)
                elif rest:
                    rest[-1] += " " + part
                else:
                    first += " " + part
        known = self.known
        out = [self.plain(first) if first else b""]
        try:
            out += [known[chunk] for chunk in rest]
        except KeyError:
            out = out[:1]
            for chunk in rest:
                ids = known.get(chunk)
                if ids is None:
                    ids = self.plain(" " + chunk)
                    if len(chunk) <= CACHED_CHARS:
                        if len(known) >= CACHE_CHUNKS:
                            known.clear()
                        known[chunk] = ids
                out.append(ids)
        return b"".join(out)
