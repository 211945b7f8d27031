"""Edit-aware token counts with a segment tree of pre-tokens for each document.

The leaves of a document's tree are its runs of non-blank characters, each
with the blanks after it; every node holds the sums of code points and tokens
below it.  An edit finds the leaves that it touches from the sums of code
points, takes the leaf before and the leaf after along as context, encodes
that stretch anew, puts it into the first of these leaves, empties the others
and updates the sums above them.  All other leaves keep their counts.  The
tokenizer encodes runs of non-blank characters one by one, so the totals equal
those of encoding the whole edited text.

Results for odd input: a null text counts as empty; null edits as none; edits
apply in order, to the text as the earlier ones left it, with null or negative
numbers read as 0, places past the end as the end and a null insertion as
empty; repeated rows are counted one by one; very long texts are read whole;
input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import SPACES, code_points, prepare, replace_columns, table
from riskframe.llm.tokens import ODD_BREAKS, WordIds, open_tokenizer

TOKENIZER = "word_bpe_49k.json"
EDITS = "array<struct<start:long,deleted:long,inserted:string>>"
#: texts whose new words go to the tokenizer together
TOGETHER = 64
COUNTS = "n_tokens long, edited_tokens long, edited_chars long, encoded_chars long"


class SegmentTree:
    """Sums of code points and tokens over the leaves of one text."""

    def __init__(self, text: str, coder: WordIds):
        self.coder = coder
        starts = np.zeros(0, np.int64)
        if not any(c in text for c in ODD_BREAKS):
            gap = SPACES[code_points(text)]
            starts = np.flatnonzero(~gap & np.append(True, gap[:-1])) if len(gap) else starts
        runs = text.split() if len(starts) else []
        if len(starts) and starts[0]:  # leading blanks are a leaf of no token
            starts, runs = np.append(0, starts), ["", *runs]
        if len(starts) and len(runs) == len(starts):
            tokens = coder.counts(runs)
        else:
            starts, tokens = np.zeros(1, np.int64), np.array([self.encoded(text)])
        self.text = text
        self.starts = starts  # of the leaves in the first text
        self.new: dict[int, str] = {}  # leaves that hold other text now
        self.size = 1 << max(0, int(len(starts) - 1).bit_length())
        self.leaves = len(starts)
        self.sums = np.zeros((2, 2 * self.size), np.int64)
        self.sums[0, self.size:self.size + self.leaves] = np.diff(np.append(starts, len(text)))
        self.sums[1, self.size:self.size + self.leaves] = tokens
        level = self.size
        while level > 1:
            below = self.sums[:, level:2 * level]
            self.sums[:, level // 2:level] = below[:, 0::2] + below[:, 1::2]
            level //= 2

    def encoded(self, text: str) -> int:
        return len(self.coder.ids(text)) // 4

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the code point at ``place``, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.sums[0, node])
            if place - begin >= left:
                begin += left
                node += 1
        return node - self.size, begin

    def leaf_text(self, leaf: int) -> str:
        if leaf in self.new:
            return self.new[leaf]
        end = self.starts[leaf + 1] if leaf + 1 < self.leaves else len(self.text)
        return self.text[self.starts[leaf]:end]

    def _put(self, first: int, last: int, text: str) -> None:
        """``text`` into the leaf ``first``, nothing into those after it up to ``last``."""
        at = self.size + first
        for leaf in range(first, last + 1):
            self.new[leaf] = ""
        self.new[first] = text
        self.sums[:, at:self.size + last + 1] = 0
        self.sums[0, at], self.sums[1, at] = len(text), self.encoded(text) if text else 0
        low, high = at // 2, (self.size + last) // 2
        while low:
            below = self.sums[:, 2 * low:2 * high + 2]
            self.sums[:, low:high + 1] = below[:, 0::2] + below[:, 1::2]
            low, high = low // 2, high // 2

    def edit(self, start: int, deleted: int, inserted: str) -> int:
        """Apply one edit; returns how many code points were encoded anew."""
        start = min(start, self.chars)
        end = min(start + deleted, self.chars)
        if not self.chars:
            self._put(0, self.leaves - 1, inserted)
            return len(inserted)
        first, begin = self.leaf_at(max(0, start - 1))
        last, _ = self.leaf_at(min(end, self.chars - 1))
        old = "".join(self.leaf_text(i) for i in range(first, last + 1))
        text = old[:start - begin] + inserted + old[end - begin:]
        self._put(first, last, text)
        return len(text)

    def whole_text(self) -> str:
        return "".join(self.leaf_text(i) for i in range(self.leaves))


def count_with_edits(docs: DataFrame, text: str = "text", edits: str = "edits", tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs`` plus n_tokens, and edited_tokens, edited_chars and encoded_chars
    (code points encoded for the edits) after the edits of each row (``EDITS``)."""
    @F.pandas_udf(COUNTS)
    def counted(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        coder = open_tokenizer(tokenizer)
        number = lambda x: 0 if x is None or x != x else max(0, int(x))
        for texts, *changes in batches:
            rows = []
            for i, (t, *own) in enumerate(zip(texts, *changes)):
                if i % TOGETHER == 0:
                    coder.learn_texts(texts.iloc[i:i + TOGETHER])
                tree = SegmentTree(t if isinstance(t, str) else "", coder)
                before, done = tree.tokens, 0
                for start, deleted, inserted in zip(*(x if x is not None else () for x in own)):
                    done += tree.edit(number(start), number(deleted), inserted or "")
                rows.append((before, tree.tokens, tree.chars, done))
            yield pd.DataFrame(rows, columns=["n_tokens", "edited_tokens", "edited_chars", "encoded_chars"], dtype="int64")

    log = F.filter(F.col(f"`{edits}`").cast(EDITS), lambda e: e.isNotNull())
    part = [log.getField(k) for k in ("start", "deleted", "inserted")]
    got = counted(F.col(f"`{text}`"), *part)
    return replace_columns(docs, got, "n_tokens", "edited_tokens", "edited_chars", "encoded_chars")


def corpus_edits() -> Column:
    """Three edits for each document, from its own text: a stretch in the
    middle is replaced by the text's start, a stretch after it is deleted, and
    the text's last code points are put in front."""
    text, n = F.coalesce(F.col("text"), F.lit("")), F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    edit = lambda at, gone, put: F.struct(F.floor(at).cast("long").alias("start"), F.lit(gone).cast("long").alias("deleted"), put.alias("inserted"))
    return F.array(edit(n / 2, 40, F.substring(text, 1, 60)), edit(2 * n / 3, 25, F.lit("")), edit(F.lit(0), 0, F.right(text, F.lit(30))))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("edits", corpus_edits())
    return count_with_edits(docs).drop("text", "edits")
