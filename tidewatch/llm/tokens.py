"""Token counts of whole texts by rank-synchronous array merging.

Texts are cut by the vocabulary's own pattern; the distinct pieces of a batch go as
ragged numpy arrays through ``merges.merge_words``; surviving symbols are counted.
Merged pieces are remembered per worker, in a table of bounded size.

Defined results: null and empty texts have no bytes and no tokens; the special
token's string inside a text is that one token, as the vocabulary's library has
it by default; rows that repeat each get a row; null ids are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship_code
from .merges import PairTable, merge_words

#: Pieces remembered per worker; beyond, the table starts anew.
REMEMBERED = 400_000
#: Characters of text worked on at a time.
CHUNK_CHARS = 2_000_000

# The pattern's classes, spelled out for texts of Latin-1 characters.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_LATIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_ANY = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
        r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


class ByteBpe:
    """A byte-level BPE vocabulary (the ``.json`` form): pieces of text to ids."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        ids = lambda xs: np.array([vocab[x] for x in xs], np.int64)
        self.table = PairTable(
            ids(a for a, _ in pairs), ids(b for _, b in pairs), ids(a + b for a, b in pairs),
            np.arange(len(pairs), dtype=np.int64), size)
        # bytes stand in the vocabulary as characters: printable ones as themselves, the others from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        name = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.byte_id = np.array([vocab[name[b]] for b in range(256)], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._any = regex.compile(_ANY).findall
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[str]:
        """The text cut by the vocabulary's pattern; special strings stay whole."""
        parts = [text]
        for s in self.special:
            parts = [x for p in parts for x in ([p] if p in self.special else _between(p, s))]
        out: list[str] = []
        for p in parts:
            if p in self.special:
                out.append(p)
            else:
                try:
                    p.encode("latin-1")
                    out += _LATIN.findall(p)
                except UnicodeEncodeError:
                    out += self._any(p)
        return out

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, flat, with offsets."""
        raw = [p.encode("utf-8") for p in pieces]
        starts = np.r_[0, np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))]
        return merge_words(self.byte_id[np.frombuffer(b"".join(raw), np.uint8)], starts, self.table)

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = [self.pieces(t) for t in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        new = list(set().union(*cut).difference(known))
        _, at = self.encode(new)
        known.update(zip(new, np.diff(at).tolist(), strict=True))
        known.update(dict.fromkeys(self.special, 1))
        return [sum(map(known.__getitem__, c)) for c in cut]


def _between(text: str, mark: str) -> list[str]:
    """``text`` split at ``mark``, with the marks kept; no empty parts."""
    out: list[str] = []
    for i, part in enumerate(text.split(mark)):
        out += [mark] * (i > 0) + [part] * bool(part)
    return out


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    """One vocabulary per worker and path."""
    return ByteBpe(path)


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in runs of about CHUNK_CHARS characters."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= CHUNK_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.  ``vocabulary`` is a path every worker can open."""
    ship_code(docs.sparkSession)
    schema = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    @F.pandas_udf(schema)
    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            texts = [t or "" for t in batch]
            n = [x for run in chunks(texts) for x in bpe.counts(run)]
            yield pd.DataFrame({"n_bytes": [len(t.encode("utf-8")) for t in texts], "n_tokens": n}, dtype="int64")

    out = docs.select(F.col(id_col).alias("doc_id"), sizes(F.col(text_col).cast("string")).alias("s"))
    return out.select("doc_id", "s.n_bytes", "s.n_tokens", (F.col("s.n_tokens") > limit).alias("over_limit"))
