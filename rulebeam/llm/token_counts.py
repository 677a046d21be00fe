"""Token counts with a whole-token shortcut (sentencepiece BPE models).

Offline proof, from the vocabulary alone. The model replaces each space by a
marker and puts one marker before the text. If no piece holds a marker after
another character, no merge can cross the border between a character and a
marker, so a text's tokens are those of its pre-tokens: a run of markers with
the characters up to the next one. If no piece holds a line feed, a line feed
is always alone and borders on both sides too. ``Vocabulary`` checks both facts and
refuses a model without them. A vocabulary string that the model splits into
itself alone counts as one token wherever it is a pre-token; these strings
are found once per task from the whole vocabulary. Only other pre-tokens are
merged by the library, each distinct one once while it stays in a bounded
memo.

Null and empty texts have 0 tokens. Rows, ties and repeated rows pass through
one by one; extra columns are ignored. A null doc_id stays null.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import read_table, text_slices, texts_of

MARK = "▁"
# Distinct pre-tokens remembered by a task before its memo starts anew.
MEMO = 400_000
OVER_LIMIT = 4096

# A run of spaces with the word behind it, a run of spaces before a line end, or a line feed.
_PRE = re.compile(r" *[^ \n]+| +|\n")


class Vocabulary:
    """Whole tokens of a sentencepiece model, and counts of single pre-tokens."""

    def __init__(self, model_file: str):
        import sentencepiece
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = [i for i in range(sp.vocab_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = [sp.id_to_piece(i) for i in normal]
        if any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in pieces):
            raise ValueError("a piece crosses a pre-token border; the shortcut does not hold for this model")
        if sp.encode("  a  ", out_type=str) == sp.encode("a", out_type=str) or sp.encode("a", out_type=str)[0][0] != MARK:
            raise ValueError("the model trims spaces or adds none before a text; the shortcut does not hold")
        # The strings as they stand in a text: markers are spaces.
        self.whole = set()
        keys = [p.replace(MARK, " ") for p in pieces]
        keys = [k for k in keys if _PRE.fullmatch(k)]
        for k, n in zip(keys, self.merge(keys)):
            if n == 1:
                self.whole.add(k)
        self.memo = dict.fromkeys(self.whole, 1)
        self.line_feed = self.merge(["\n"])[0]

    def merge(self, keys: list[str]) -> list[int]:
        """Tokens of single pre-tokens by the library's merges. The library
        adds a marker of its own, which stands for a key's first space;
        other keys go behind a line feed, whose tokens are then left out."""
        feed = len(self.sp.encode("\n"))
        ids = self.sp.encode([k[1:] if k[0] == " " else "\n" + k for k in keys], num_threads=1)
        # Nothing is left of a lone space; the library then adds no marker.
        return [len(x) - (0 if k[0] == " " else feed) if k != " " else 1 for k, x in zip(keys, ids)]

    def count(self, texts: list[str]) -> list[int]:
        # A marker written in a text is the same to the model as a space.
        split = [_PRE.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        new = set().union(*split).difference(self.memo)
        if len(self.memo) + len(new) > len(self.whole) + MEMO:
            self.memo = dict.fromkeys(self.whole, 1)
            new = set().union(*split).difference(self.memo)
        if new:
            new = list(new)
            self.memo.update(zip(new, self.merge(new)))
        get = self.memo.__getitem__
        return [sum(map(get, p)) for p in split]


def add_token_counts(docs: DataFrame, model_file: str, limit: int = OVER_LIMIT, text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``."""

    def run(batches):
        vocabulary = None
        for part, data, offs in text_slices(batches, text):
            vocabulary = vocabulary or Vocabulary(model_file)
            n = vocabulary.count(texts_of(data, offs))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offs), pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    cols = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", f"CAST(`{text}` AS STRING) AS `{text}`")
    return cols.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return add_token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
