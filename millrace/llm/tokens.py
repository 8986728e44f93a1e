"""Token counts from pre-token frequencies, without token ids per document.

Each Arrow batch is cut into pre-tokens; the pieces of a pre-token are counted once by the tokenizer's
model, and kept in the worker's table of counts; the documents' pre-token frequencies are joined to that
table and summed. The table is emptied when it holds ``TABLE_ROWS`` pre-tokens, so its memory is bounded
and counts never change. A table shared by all tasks would be a shuffle of every document's distinct
pre-tokens, several times the input.

Runs of characters whose classes no Unicode version disputes are cut by a pattern, texts with any other
character by the tokenizer's own pre-tokenizer; both go into the same frequencies. Special strings are cut out
first and count as one token each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

TABLE_ROWS = 400_000

#: The pattern of byte-level pre-tokenizers (fixed value); white space as in Unicode's White_Space.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Characters whose classes agree in every Unicode version and library; other texts are cut by the library.
PLAIN = regex.compile("[\\t\\n\\r\\x20-\\x7e\\xa0-\\u024f]*+")


class PieceCounter:
    """Counts of pieces per pre-token for one byte-level tokenizer file without a normaliser."""

    def __init__(self, path: str):
        self.path, self.tokenizer, self.table = path, None, {}

    def open(self) -> None:
        if self.tokenizer is None:
            self.tokenizer = Tokenizer.from_file(self.path)
            self.tokenizer.no_padding()
            self.tokenizer.no_truncation()
            added = self.tokenizer.get_added_tokens_decoder().values()
            if self.tokenizer.normalizer is not None or any(t.lstrip or t.rstrip or t.single_word for t in added):
                raise ValueError(f"{self.path} normalises texts or joins added tokens to their surroundings")
            strings = sorted((t.content for t in added if t.content), key=len, reverse=True)
            self.special = regex.compile("|".join(map(regex.escape, strings))) if strings else None

    def frequencies(self, text: str) -> tuple[Counter[str], int]:
        """The text's pre-tokens and the number of special strings between them."""
        parts = self.special.split(text) if self.special else [text]
        found: Counter[str] = Counter()
        for part in parts:
            if PLAIN.fullmatch(part):
                found.update(PRE_TOKEN.findall(part))
            else:
                found.update(part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
        return found, len(parts) - 1

    def counts(self, texts: list[str | None]) -> Iterator[int]:
        self.open()
        frequencies, sums = [], []
        for text in texts:
            frequency, special = self.frequencies(text or "")
            frequencies.append(frequency)
            sums.append(special)
            if len(frequencies) == 256:
                yield from self._joined(frequencies, sums)
                frequencies, sums = [], []
        yield from self._joined(frequencies, sums)

    def _joined(self, frequencies: list[dict[str, int]], sums: list[int]) -> Iterator[int]:
        if len(self.table) > TABLE_ROWS:
            self.table = {}
        table = self.table
        new = list({p for f in frequencies for p in f if p not in table})
        for start in range(0, len(new), 4096):
            part = new[start : start + 4096]
            for pre_token, pieces in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                table[pre_token] = len(pieces)
        for frequency, rest in zip(frequencies, sums, strict=True):
            yield rest + sum(table[p] * n for p, n in frequency.items())


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; null and empty texts have none.

    No begin, end or other added tokens; special strings inside texts count as the library counts them.
    The tokenizer's file must lie at ``tokenizer_path`` on every executor. Repeated rows are counted each.
    """
    counter = PieceCounter(tokenizer_path)

    def work(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(counter.counts(texts)), pa.int64()), batch.column(2)],
                ["doc_id", "n_tokens", "n_bytes"],
            )

    counted = documents.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = counted.mapInArrow(work, "doc_id long, n_tokens long, n_bytes long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
