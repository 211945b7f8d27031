"""Line dedup by pairwise alignment.

A line of at least ``TELLING`` words is telling: the same one in two documents
is no accident.  A shorter line counts together with its neighbours: with the
lines before it, as many as reach ``TELLING`` words with it, and likewise with the
lines after it (blank lines do not count).  Such a window is a key of its own, so
a passage of short lines is found wherever it stands, and a changed line is in
the windows near it only.  In scripts written without blanks each character
counts as a word.  The n-th occurrence of a key in a document is another key than
the first.

For each key the earliest document that holds it is found by a partial
aggregate, so a line that a third of all documents share costs one row per
task.  A document and each earlier one that it meets are aligned by patience:
the longest increasing sequence of the places of the lines both hold is the
alignment.  Aligned lines form blocks (neighbours in both documents); blocks of at
least ``BLOCK_WORDS`` words go from the later document.  Keys of which a line stays
(it crosses others, say) meet the next earlier holder, and so on until no line
that stays has an earlier holder left.  The earliest holder of a line keeps it, so
no text is lost from the corpus.

"Earlier" is the order of (doc_id, hash of the text), null doc_id last.  A
document whose every line that is not blank went is dropped by ``deduped``.

Results for odd input: a null or empty text has no lines and stays as it is;
rows that repeat both doc_id and text are one document and get the same
result; very long texts are handled whole; an empty table gives an empty
result; other columns pass through (n_chars is renewed where text changed).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import MAX_LONG, prepare, table

TELLING = 8
BLOCK_WORDS = 8
#: place: number of the line among those that are not blank; sizes: words (255 at
#: most) of the lines of the key's window; back: the window ends at the place
KEYS = "id long, hash long, k1 long, k2 long, place int, sizes binary, back boolean"
KINDS = (pa.int64(),) * 4 + (pa.int32(), pa.binary(), pa.bool_())
#: letters of scripts written without blanks (Thai, Lao, Burmese, Khmer, kana, Han)
UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNITS = re.compile(f"[{UNSPACED}]|[^\\s{UNSPACED}]+")


def _key(*parts: bytes) -> bytes:
    h = blake2b(digest_size=16)
    for p in parts:
        h.update(len(p).to_bytes(8, "little"))
        h.update(p)
    return h.digest()


def words_of(line: str) -> int:
    return len(line.split()) if line.isascii() else len(_UNITS.findall(line))


def sizes_of(text: str) -> tuple[list[str], list[int], list[int]]:
    """The lines that are not blank, their places in the text and their words."""
    at = [(x.strip(), i) for i, x in enumerate(text.split("\n")) if x.strip()]
    return [x for x, _ in at], [i for _, i in at], [words_of(x) for x, _ in at]


def windows(text: str) -> list[tuple[bytes, int, list[int], bool]]:
    """(key, place, words of its lines, back) for each telling line and for the
    windows before and after each short line, where they reach ``TELLING`` words."""
    lines, _, sizes = sizes_of(text)
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    out, seen = [], Counter()

    def add(key: bytes, place: int, words: list[int], back: bool) -> None:
        seen[key] += 1
        out.append((_key(key, seen[key].to_bytes(8, "little")) if seen[key] > 1 else key, place, words, back))

    for i, n in enumerate(sizes):
        if n >= TELLING:
            add(_key(raw[i]), i, [n], False)
            continue
        b, total = i, n
        while total < TELLING and b > 0:
            b -= 1
            total += sizes[b]
        if total >= TELLING:
            add(_key(b"back", *raw[b:i + 1]), i, sizes[b:i + 1], True)
        e, total = i, n
        while total < TELLING and e < len(sizes) - 1:
            e += 1
            total += sizes[e]
        if total >= TELLING:
            add(_key(b"ahead", *raw[i:e + 1]), i, sizes[i:e + 1], False)
    return out


def line_keys(text: str) -> list[tuple[bytes, int, int]]:
    """(key, place in the text, words) of each line with a key."""
    _, at, sizes = sizes_of(text)
    return [(key, at[place], sizes[place]) for key, place, _, _ in windows(text)]


def _spread(f: dict) -> Iterator[tuple[int, int, int]]:
    """(place, place in the source, words) of the lines of a shared window."""
    sizes = f.get("sizes")
    if sizes is None:
        yield f["pos"], f["source_pos"], f["words"]
        return
    first = 1 - len(sizes) if f["back"] else 0
    for k, n in enumerate(sizes):
        yield f["pos"] + first + k, f["source_pos"] + first + k, n


def aligned(found: list[dict]) -> set[int]:
    """Places of the lines that go, from the keys a document shares with earlier ones."""
    by_source: dict[tuple, set[tuple[int, int, int]]] = {}
    for f in found:
        by_source.setdefault((f["source"], f["source_hash"]), set()).update(_spread(f))
    gone: set[int] = set()
    for shared in by_source.values():
        pairs = sorted(shared, key=lambda x: (x[0], -x[1]))  # of one place at most one pair
        tails, at, back = [], [], [-1] * len(pairs)  # patience piles over the places in the source
        for i, (_, j, _) in enumerate(pairs):
            p = bisect_left(tails, j)
            back[i] = at[p - 1] if p else -1
            if p == len(tails):
                tails.append(j)
                at.append(i)
            else:
                tails[p], at[p] = j, i
        chain, i = [], at[-1] if at else -1
        while i >= 0:
            chain.append(pairs[i])
            i = back[i]
        block: list[tuple[int, int, int]] = []
        for line in [*reversed(chain), None]:
            if block and (line is None or line[0] != block[-1][0] + 1 or line[1] != block[-1][1] + 1):
                if sum(b[2] for b in block) >= BLOCK_WORDS:
                    gone.update(b[0] for b in block)
                block = []
            if line:
                block.append(line)
    return gone


def sources_of(found: list[dict], gone: set[int]) -> list[int]:
    return sorted({f["source"] for f in found if any(p in gone for p, _, _ in _spread(f))})


def identity(key: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    return (F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(MAX_LONG)), F.xxhash64(F.col(f"`{text}`")))


def shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, hash, found): for each document its keys that earlier ones hold too."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cols = [[] for _ in KINDS]
            for i, h, t in zip(ids, hashes, batch.column(2)):
                for k, place, sizes, back in windows(t.as_py()):
                    for c, v in zip(cols, (i, h, int.from_bytes(k[:8], "little", signed=True), int.from_bytes(k[8:], "little", signed=True),
                                           place, bytes(min(n, 255) for n in sizes), back)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, KINDS)], names=[x.split()[0] for x in KEYS.split(", ")])

    own, hashed = identity(key, text)
    texts = docs.where(F.col(f"`{text}`").isNotNull()).select(own.alias("id"), hashed.alias("hash"), F.col(f"`{text}`").alias("text"))
    lines = texts.mapInArrow(keyed, KEYS).checkpoint()
    who = F.struct("id", "hash")
    held = F.min(F.struct("id", "hash", "place")).alias("first")
    first = lines.groupBy("k1", "k2").agg(held, F.max(who).alias("last")).where(
        (F.col("first.id") != F.col("last.id")) | (F.col("first.hash") != F.col("last.hash"))).drop("last")
    later = F.struct("id", "hash") > F.struct("first.id", "first.hash")
    # rows of a document may repeat
    met = lines.join(first, ["k1", "k2"]).where(later).distinct().checkpoint()
    found = met
    while True:
        # keys of which a line stays meet their next holder
        stay = _staying(_collected(found)).checkpoint()
        at = found.join(stay, ["id", "hash", "k1", "k2", "place"], "left_semi").groupBy(*[c for c in found.columns if c != "first"]).agg(
            F.max(F.struct("first.id", "first.hash")).alias("seen"))
        after = (lines.join(at.select("k1", "k2", "seen").distinct(), ["k1", "k2"]).where(who > F.col("seen"))
                 .groupBy("k1", "k2", "seen").agg(held))
        met = at.join(after, ["k1", "k2", "seen"]).where(later).select(*found.columns).checkpoint()
        if not met.limit(1).count():
            return _collected(found)
        found = found.unionByName(met)


def _collected(found: DataFrame) -> DataFrame:
    one = F.struct("k1", "k2", F.col("place").alias("pos"), "sizes", "back", F.col("first.id").alias("source"),
                   F.col("first.hash").alias("source_hash"), F.col("first.place").alias("source_pos"))
    return found.groupBy("id", "hash").agg(F.collect_list(one).alias("found"))


def _staying(collected: DataFrame) -> DataFrame:
    """(id, hash, k1, k2, place) of the found keys of which a line stays."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = set()
            for i, h, found in zip(*(c.to_pylist() for c in batch.columns)):
                gone = aligned(found)
                rows.update((i, h, f["k1"], f["k2"], f["pos"]) for f in found if any(p not in gone for p, _, _ in _spread(f)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * 5, KINDS)],
                                             names=["id", "hash", "k1", "k2", "place"])

    return collected.mapInArrow(check, "id long, hash long, k1 long, k2 long, place int")


def with_deletions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` plus __kept (the text that stays), __deleted (places of the lines
    that go) and __sources (ids of the earlier documents they align with)."""
    @F.pandas_udf("kept string, deleted array<int>, sources array<long>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, shared in batches:
            rows = []
            for t, found in zip(texts, shared):
                found = [] if found is None or not isinstance(t, str) else list(found)
                went = aligned(found)
                if not went:
                    rows.append((t, [], []))
                    continue
                at = sizes_of(t)[1]
                gone = {at[p] for p in went}
                kept = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
                rows.append((kept if kept.strip() else "", sorted(gone), sources_of(found, went)))
            yield pd.DataFrame(rows, columns=["kept", "deleted", "sources"])

    own, hashed = identity(key, text)
    # as nondeterministic no condition on the result is moved below it, where it would cut every text a second time
    cut = cut.asNondeterministic()
    found = shared_lines(docs, key, text).select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), F.col("found").alias("__found"))
    got = docs.withColumn("__id", own).withColumn("__hash", hashed).join(found, ["__id", "__hash"], "left")
    got = got.withColumn("__cut", cut(F.col(f"`{text}`"), F.col("__found")))
    return got.select(*[f"`{c}`" for c in docs.columns], F.col("__cut.kept").alias("__kept"),
                      F.col("__cut.deleted").alias("__deleted"), F.col("__cut.sources").alias("__sources"))


def deduped(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that go, nor the documents of which nothing stays."""
    got = with_deletions(docs).where((F.size("__deleted") == 0) | (F.col("__kept") != ""))
    changed = F.size("__deleted") > 0
    new = {"text": F.col("__kept"), "n_chars": F.when(changed, F.length("__kept").cast("long")).otherwise(F.col("n_chars"))
           if "n_chars" in docs.columns else None}
    return got.select(*[(new[c] if new.get(c) is not None else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op10_line_dedup(spark, sf_dir: str) -> DataFrame:
    prepare(spark)
    got = with_deletions(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", F.col("__kept").alias("text"), F.col("__deleted").alias("deleted_lines"),
                      F.col("__sources").alias("sources"))
