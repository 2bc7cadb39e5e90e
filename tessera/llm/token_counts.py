"""Token counts without token ids: pieces are counted once for each distinct pre-token and joined to the documents.

First pass: corpus frequencies of pre-tokens. Each distinct pre-token goes once through the BPE model of the tokeniser
file, which gives its number of pieces. Second pass: per-document pre-token frequencies join that table and are summed.
The most frequent pre-tokens (no more than ``hot`` rows) are joined by broadcast; all others by a shuffle on the
pre-token, where no key is hot any more. Special tokens inside texts count as one, as the library has it by default.

Null and empty texts have no tokens. Repeated rows of one id each get their own count.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import most_frequent, stored


class PreTokens:
    """Pre-tokens of a text under a tokenizers .json file, as strings before the byte-level mapping, and the special tokens in it."""

    def __init__(self, name: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        spec = json.loads(open(public_tokenizers.path(name), encoding="utf-8").read())
        self.whole = Tokenizer.from_str(json.dumps(spec))
        added = [a["content"] for a in spec["added_tokens"]]
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] for a in spec["added_tokens"]):
            raise ValueError(f"{name}: special tokens of this kind are not supported")
        self.special = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.hint = [a[:2] for a in added]
        kinds = [p["type"] for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        norms = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["Split", "ByteLevel"] or norms != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{name}: {norms} and {kinds} are not supported")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        #: In these texts NFC changes nothing, and lower case and classes are the same in Python and in the library.
        self.plain = regex.compile(r"[\t-\r\x20-\x7e\xa0-įı-ž]*+")
        self.normalizer = self.whole.normalizer
        self.splitter = pre_tokenizers.Split(self._pattern(spec), "removed", invert=True)
        model = dict(spec, normalizer=None, added_tokens=[], pre_tokenizer={"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False})
        self.model = Tokenizer.from_str(json.dumps(model))
        del normalizers

    @staticmethod
    def _pattern(spec: dict):
        from tokenizers import Regex

        return Regex(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def of(self, text: str) -> tuple[list[str], int]:
        if not text:
            return [], 0
        if self.special and any(h in text for h in self.hint) and (found := self.special.findall(text)):
            parts = [self._of(p) for p in self.special.split(text) if p]
            return [t for p in parts for t in p], len(found)
        return self._of(text), 0

    def _of(self, text: str) -> list[str]:
        if self.plain.fullmatch(text):
            return self.split.findall(text.lower())
        return [t for t, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch_fast(tokens, add_special_tokens=False)]


@cache
def pre_tokens(name: str) -> PreTokens:
    return PreTokens(name)


def vocabulary(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """token, n (occurrences in all documents), pieces: one row for each distinct pre-token."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = pre_tokens(tokenizer).of, Counter()
        for b in batches:
            for text in b.column(0):
                held.update(of(text.as_py())[0])
            if len(held) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["token", "n"])
                held = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["token", "n"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pre_tokens(tokenizer)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.pieces(b.column(0).to_pylist()), pa.int64())], names=["token", "n", "pieces"])

    seen = docs.select(F.col(text_col)).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return seen.mapInArrow(encode, "token string, n long, pieces long")


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", hot: int = 100_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens."""
    spark = docs.sparkSession
    vocab = stored(vocabulary(docs, tokenizer, text_col), "pre-tokens")
    top = {r["token"]: r["pieces"] for r in most_frequent(vocab, "n", hot).select("token", "pieces").collect()}
    shared = spark.sparkContext.broadcast(top)
    split = len(top) < vocab.count()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for the document (token null) and one for each of its pre-tokens outside the broadcast."""
        of, known = pre_tokens(tokenizer).of, shared.value
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for row, doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                text = text.as_py() or ""
                tokens, total = of(text)
                rare = []
                for t in tokens:
                    k = known.get(t)
                    if k is None:
                        rare.append(t)
                    else:
                        total += k
                for values in ((row, doc, None, len(text.encode()), total), *((row, None, t, None, k) for t, k in Counter(rare).items())):
                    for column, x in zip(out, values, strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["row", "doc_id", "token", "n_bytes", "n"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(frequencies, "row long, doc_id long, token string, n_bytes long, n long")
    if not split:  # the whole table went by broadcast
        return rows.select("doc_id", "n_bytes", F.col("n").alias("n_tokens"))
    rows = stored(rows, "frequencies")
    rare = rows.where("token is not null").select("row", "token", "n").join(vocab.select("token", "pieces"), "token").select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"), (F.col("n") * F.col("pieces")).alias("n"))
    return rows.where("token is null").select("row", "doc_id", "n_bytes", "n").unionByName(rare).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens")).drop("row")
