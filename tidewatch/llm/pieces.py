"""SentencePiece (BPE model) encoding and decoding by vectorised merge rounds.

The model's pieces and scores are read from its file.  Any two neighbours whose
joined text is a piece may merge, best score first.  No piece crosses from another
character to a word mark, and characters found in no longer piece never merge, so a
text is cut there into words without changing the result; the distinct words of a
batch go through ``merges.merge_words`` together.  Symbols that are no pieces fall back
to byte ids.

Defined results: null and empty texts have no ids and decode to the empty text;
rows that repeat each get a row; null ids are kept.
"""

from __future__ import annotations

import hashlib
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
from .tokens import REMEMBERED, chunks

#: Stands for a space in pieces (fixed by the model format).
MARK = "▁"


class PieceBpe:
    """A BPE SentencePiece model with byte fallback and no normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        score = {i: lib.get_score(i) for i in normal}
        self.id = {pieces[i]: i for i in normal}
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        long = [p for p in self.id if len(p) > 1]
        chars = {c for p in long for c in p}
        # characters that occur in pieces but are none get ids beyond the model's
        symbol = dict(self.id)
        for c in sorted(chars - symbol.keys()):
            symbol[c] = n + len(symbol) - len(self.id)
        self.symbol, self.n = symbol, n
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        rows = [(symbol[p[:k]], symbol[p[k:]], self.id[p], order[score[self.id[p]]])
                for p in long for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol]
        left, right, out, rank = np.array(rows, np.int64).reshape(-1, 4).T
        self.table = PairTable(left, right, out, rank, max(symbol.values(), default=0) + 1)
        inner = re.escape("".join(sorted(chars - {MARK})))
        # a run of marks with what follows of mergeable characters, or one character that never merges
        self.cut = re.compile(f"{MARK}+[{inner}]*|[{inner}]+|[^{inner}{MARK}]").findall
        assert not any(MARK in p.lstrip(MARK) for p in long), "a piece crosses words"
        # what each id decodes to
        self.bytes = [b""] * n
        for p, i in self.id.items():
            self.bytes[i] = p.replace(MARK, " ").encode("utf-8")
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        self.name = [str(i) for i in range(n)]
        self.spell = {v: k for k, v in symbol.items() if v >= n}
        # symbol of each character; -1 where it never merges and is no piece
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.ids_of: dict[str, str] = {}
        self.raw_of: dict[str, bytes] = {}
        self.number_of: dict[str, bytes] = {}

    def encode_flat(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids of all words, flat, with the words' offsets."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        starts = np.r_[0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        sym = self.of_char[codes]
        lone = np.flatnonzero(sym < 0)
        # a character that never merges is a word of its own, so it comes back in place
        if len(lone):
            sym = np.where(sym < 0, self.table.n - 1, sym)
        out, at = merge_words(sym, starts, self.table)
        odd = np.flatnonzero(out >= self.n)
        if not len(odd):
            return out.tolist(), at.tolist()
        # symbols that are no pieces give way to the ids of their bytes
        spelt = [chr(codes[starts[w]]) if out[i] == self.table.n - 1 else self.spell[int(out[i])]
                 for i, w in zip(odd.tolist(), (np.searchsorted(at, odd, side="right") - 1).tolist(), strict=True)]
        more = [self._fallback(c) for c in spelt]
        size = np.ones(len(out), np.int64)
        size[odd] = [len(x) for x in more]
        place = np.r_[0, np.cumsum(size)]
        flat = np.repeat(out, size)
        into = np.repeat(place[odd], size[odd]) + np.concatenate([np.arange(len(x)) for x in more])
        flat[into] = np.concatenate(more)
        return flat.tolist(), place[at].tolist()

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        flat, at = self.encode_flat(words)
        return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def _fallback(self, c: str) -> list[int]:
        return [self.byte[b] for b in c.encode("utf-8")]

    def words(self, text: str) -> list[str]:
        """The marked text, cut where nothing can merge."""
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, cut: list[list[str]]) -> None:
        """Remember the new words of a batch: their ids as text and their decoded bytes."""
        if len(self.ids_of) > REMEMBERED:
            self.ids_of.clear()
            self.raw_of.clear()
        new = list(set().union(*cut).difference(self.ids_of))
        flat, at = self.encode_flat(new)
        name = list(map(self.name.__getitem__, flat))
        raw = list(map(self.bytes.__getitem__, flat))
        ends = at[1:]
        self.ids_of.update(zip(new, [",".join(name[a:b]) for a, b in zip(at, ends, strict=False)], strict=True))
        self.raw_of.update(zip(new, [b"".join(raw[a:b]) for a, b in zip(at, ends, strict=False)], strict=True))

    def remembered(self, cut: list[str]) -> tuple[str, str]:
        """Ids as text and decoded text of a cut text whose words are all remembered."""
        return ",".join(map(self.ids_of.__getitem__, cut)), self.text(b"".join(map(self.raw_of.__getitem__, cut)))

    def joined(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in ids])

    def id_arrays(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as uint16; the distinct words of all texts are merged together."""
        cut = [self.words(t) for t in texts]
        if len(self.number_of) > REMEMBERED:
            self.number_of.clear()
        new = list(set().union(*cut).difference(self.number_of))
        flat, at = self.encode_flat(new)
        raw = np.array(flat, np.uint16).tobytes()
        self.number_of.update(zip(new, [raw[2 * a:2 * b] for a, b in zip(at, at[1:], strict=False)], strict=True))
        return [np.frombuffer(b"".join(map(self.number_of.__getitem__, c)), np.uint16) for c in cut]

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        return [i for ids in self.encode_words(self.words(text)) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the leading mark goes, byte ids are read as UTF-8."""
        return self.text(self.joined(ids))

    @staticmethod
    def text(raw: bytes) -> str:
        return raw.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=4)
def piece_bpe(path: str) -> PieceBpe:
    """One model per worker and path."""
    return PieceBpe(path)


_SCHEMA = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())])


def encode_decode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (decimal, comma-joined), decoded text; or the SHA-256 of both.

    ``model`` is a path every worker can open.
    """

    ship_code(docs.sparkSession)
    @F.pandas_udf(_SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = piece_bpe(model)
        for batch in batches:
            rows = []
            for texts in chunks([t or "" for t in batch]):
                cut = [bpe.words(t) for t in texts]
                bpe.learn(cut)
                for c in cut:
                    ids, text = bpe.remembered(c)
                    n = ids.count(",") + bool(ids)
                    if digests:
                        ids = hashlib.sha256(ids.encode()).hexdigest()
                        text = hashlib.sha256(text.encode("utf-8")).hexdigest()
                    rows.append((n, ids, text))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])

    out = docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col).cast("string")).alias("s"))
    names = ("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")
    return out.select("doc_id", "s.n_tokens", F.col("s.ids").alias(names[0]), F.col("s.decoded").alias(names[1]))
