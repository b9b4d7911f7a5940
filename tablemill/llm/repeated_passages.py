"""Removal of passages that repeat across documents.

A window is ``size`` consecutive words. A window that also starts in a document with a
smaller id is removed from the later one.

1. Anchors. Each window picks, of the shorter word sequences in it, the one of smallest
   hash. Equal windows pick equal anchors, so a window can only repeat if its anchor
   does, and only every fourth word starts an anchor. Anchors are shuffled once and go
   back to the buckets of documents that hold repeated ones.
2. Windows over repeated anchors are shuffled by hash; those that start in two documents
   are candidates, and the smallest document that has them is their first.
3. The bucket of the first document cuts the passages that others ask for (runs of
   windows) out of its text and sends them to the buckets that asked.
4. Every bucket is a shard: stretches of these texts that its documents seem to hold are
   compiled into an Aho-Corasick automaton, and all documents of the bucket are streamed
   through it. Words go where the text of a first document matches.

A bucket has a few MB of text, so an automaton is bounded, and no shard reads documents
of another. Before a shuffle each bucket reports a hash once, so a passage that stands in
a third of all documents is one row per bucket. Buckets that ask for one window are dealt to
relays of bounded number: the bucket of the first document answers the relays, these the
buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemill.spec import col

SIZE = 13
ANCHOR = 7
BUCKET_CHARS = 6_000_000
# Buckets, about, that get a window from one relay.
ASKERS = 2_000
NO_DOCUMENT = np.iinfo(np.int64).max

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return (text or "").encode().split()


class Bucket:
    """Word hashes of the documents of one bucket, end to end."""

    def __init__(self, ids: np.ndarray, words: list[list[bytes]]):
        from xxhash import xxh3_64_intdigest

        self.ids, self.words = ids, words
        sizes = np.array([len(w) for w in words], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.hashes = np.fromiter(
            (xxh3_64_intdigest(x) for w in words for x in w), np.uint64, int(self.begin[-1])
        )
        self.owner = np.repeat(np.arange(len(words)), sizes)
        self.known = {1: self.hashes}

    def sequences(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from every position where so many are left at all, out
        of the hashes of its two halves."""
        if n not in self.known:
            left, right = self.sequences(n - n // 2), self.sequences(n // 2)
            count = max(0, len(self.hashes) - n + 1)
            self.known[n] = mix(left[:count] * GOLDEN + right[n - n // 2 :][:count])
        return self.known[n]

    def windows(self, size: int):
        """Start and hash of every window inside one document."""
        found = self.sequences(size)
        starts = np.flatnonzero(self.owner[: len(found)] == self.owner[size - 1 : size - 1 + len(found)])
        return starts, found[starts]

    def anchors(self, starts: np.ndarray, size: int, anchor: int) -> np.ndarray:
        """Smallest hash of the sequences of ``anchor`` words in each window."""
        parts = self.sequences(anchor)
        count = max(0, len(self.hashes) - size + 1)
        least = parts[:count].copy()
        for i in range(1, size - anchor + 1):
            np.minimum(least, parts[i : i + count], out=least)
        return least[starts]


def read_bucket(table: pa.Table) -> Bucket:
    return Bucket(table.column("id").to_numpy(), [split(t) for t in table.column("text").to_pylist()])


def hashes(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def least_by_key(keys: np.ndarray, values: np.ndarray):
    """Distinct keys with their smallest and largest value."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    last = np.append(first[1:], len(keys)) - 1
    return keys[first], values[first], values[last] if len(keys) else values


def stretches(*steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the stretches in which all but the last of the given arrays
    go on by one and the last stays the same."""
    moves = [np.diff(x) != 1 for x in steps[:-1]] + [np.diff(steps[-1]) != 0]
    cut = np.flatnonzero(np.logical_or.reduce(moves)) + 1
    return np.append(0, cut), np.append(cut, len(steps[-1])) - 1


def asked_passages(bucket: Bucket, w: np.ndarray, asker: np.ndarray, size: int, first: np.ndarray | None = None):
    """Asker, document and text of the longest runs of windows that an asker wants; with
    ``first``, the document of each window, where they start there first."""
    starts, found = bucket.windows(size)
    wanted, one = np.unique(w, return_index=True)
    if len(wanted) == 0 or len(found) == 0:
        return
    place = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
    mine = wanted[place] == found
    if first is not None:
        mine &= first[one][place] == bucket.ids[bucket.owner[starts]]
    starts, found = starts[mine], found[mine]
    keys, one = np.unique(found, return_index=True)
    if len(keys) == 0:
        return
    place = np.minimum(np.searchsorted(keys, w), len(keys) - 1)
    hit = keys[place] == w
    at, asker = starts[one][place[hit]], asker[hit]
    order = np.lexsort((at, asker))
    at, asker = at[order], asker[order]
    # The last words of a document start no window, so no run goes on into the next.
    for a, b in zip(*stretches(at, asker)):
        doc = int(bucket.owner[at[a]])
        left = int(at[a] - bucket.begin[doc])
        text = b" ".join(bucket.words[doc][left : left + int(at[b] - at[a]) + size])
        yield int(asker[a]), int(bucket.ids[doc]), text.decode()


def removed_words(bucket: Bucket, passages: Bucket, size: int) -> list[np.ndarray]:
    """A mask of removed words per document. ``passages`` are texts of first documents; the
    automaton is made of their stretches whose hashes stand in a document side by side."""
    import ahocorasick

    masks = [np.zeros(len(w), bool) for w in bucket.words]
    if len(passages.hashes) < size or len(bucket.hashes) < size:
        return masks
    theirs, keys = passages.windows(size)
    first = passages.ids[passages.owner[theirs]]
    order = np.lexsort((theirs, first, keys))
    order = order[np.diff(keys[order], prepend=~keys[order[:1]]) != 0]
    theirs, keys, first = theirs[order], keys[order], first[order]
    starts, found = bucket.windows(size)
    place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    hit = np.flatnonzero((keys[place] == found) & (first[place] < bucket.ids[bucket.owner[starts]]))
    if len(hit) == 0:
        return masks
    automaton = ahocorasick.Automaton()
    runs = list(zip(*stretches(starts[hit], theirs[place[hit]], bucket.owner[starts[hit]])))

    def add(a: int, b: int) -> str:
        """Windows ``a`` to ``b`` of the hits as the first document has them."""
        at = int(theirs[place[hit[a]]])
        doc = int(passages.owner[at])
        at -= int(passages.begin[doc])
        words = passages.words[doc][at : at + b - a + size]
        text = " " + b" ".join(words).decode() + " "
        known = automaton.get(text, None)
        if known is None or known[1] > passages.ids[doc]:
            automaton.add_word(text, (len(words), int(passages.ids[doc])))
        return text

    def same(a: int, b: int, text: str) -> bool:
        doc = int(bucket.owner[starts[hit[a]]])
        left = int(starts[hit[a]] - bucket.begin[doc])
        return b" ".join(bucket.words[doc][left : left + b - a + size]).decode() == text[1:-1]

    for a, b in runs:
        # Equal hashes of different texts: each window of the run stands for itself.
        if not same(a, b, add(a, b)):
            for i in range(a, b + 1):
                add(i, i)
    automaton.make_automaton()
    for doc in np.unique(bucket.owner[starts[hit]]).tolist():
        text = " " + b" ".join(bucket.words[doc]).decode() + " "
        ends = np.cumsum([len(x) + 1 for x in text[1:-1].split(" ")])
        for end, (length, origin) in automaton.iter(text):
            if origin < bucket.ids[doc]:
                last = int(np.searchsorted(ends, end)) + 1
                masks[doc][last - length : last] = True
    return masks


def _dealt(df: DataFrame, id_column: str, text_column: str, bucket_chars: int) -> DataFrame:
    """``bucket``, ``id``, ``text``; the number of buckets follows the text."""
    chars = df.agg(F.sum(F.length(col(text_column)))).first()[0] or 0
    buckets = int(chars // bucket_chars) + 1
    ident = col(id_column).cast("long")
    # A null id is larger than all others: its passages are never the first.
    rows = df.select(
        F.coalesce(ident, F.lit(int(NO_DOCUMENT))).alias("id"), ident.isNull().alias("no_id"),
        col(text_column).alias("text"),
    )
    return rows.select(
        F.pmod(F.xxhash64("id", "text"), F.lit(buckets)).cast("int").alias("bucket"), "id", "no_id", "text"
    ).repartition("bucket")


def repeated_passages(
    df: DataFrame,
    size: int = SIZE,
    id_column: str = "doc_id",
    text_column: str = "text",
    anchor: int = ANCHOR,
    bucket_chars: int = BUCKET_CHARS,
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``spans`` (first word and end of each
    removed stretch, from 0) and ``kept`` (words left, joined by one space).

    A null text has no words; texts shorter than a window lose none. Rows that share an
    id never remove each other's words; a null id counts as larger than all others, and
    passages shared by null ids only stay. The order of repeated rows is of no account.
    Ids are whole numbers; other columns are not read. Hashes of 64 bits only propose: a word goes
    where the text of a smaller document matches. Where two windows share a hash, one that
    repeats may stay; none goes that does not.
    """
    dealt = _dealt(df, id_column, text_column, bucket_chars)

    def anchors(table: pa.Table) -> pa.Table:
        bucket = read_bucket(table)
        starts, _ = bucket.windows(size)
        keys, low, high = least_by_key(bucket.anchors(starts, size, anchor), bucket.ids[bucket.owner[starts]])
        number = table.column("bucket")[0].as_py() if table.num_rows else 0
        # Twice the bucket's number, and one more where two of its documents have it.
        report = np.full(len(keys), 2 * number, np.int64) + (low != high)
        return pa.table({"anchor": keys.view(np.int64), "report": report})

    reports = dealt.groupBy("bucket").applyInArrow(anchors, "anchor long, report long")
    every = Window.partitionBy("anchor")
    repeated = (
        reports.withColumn("n", F.count("*").over(every)).withColumn("twice", F.max(F.col("report") % 2).over(every))
        .where("n > 1 or twice = 1")
        .select(F.floor(F.col("report") / 2).cast("int").alias("bucket"), "anchor")
    )

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = low = high = np.empty(0, np.int64)
        number = 0
        if left.num_rows and right.num_rows:
            number = left.column("bucket")[0].as_py()
            bucket = read_bucket(left)
            starts, found = bucket.windows(size)
            anchor_of = bucket.anchors(starts, size, anchor)
            wanted = np.sort(hashes(right.column("anchor")))
            place = np.minimum(np.searchsorted(wanted, anchor_of), len(wanted) - 1)
            hit = wanted[place] == anchor_of
            keys, low, high = least_by_key(found[hit], bucket.ids[bucket.owner[starts[hit]]])
        report = np.full(len(keys), 2 * number, np.int64) + (low != high)
        return pa.table({"w": keys.view(np.int64), "low": low, "report": report})

    found = (
        dealt.groupBy("bucket").cogroup(repeated.groupBy("bucket"))
        .applyInArrow(windows, "w long, low long, report long")
    )
    every = Window.partitionBy("w")
    bucket_of = F.floor(F.col("report") / 2).cast("int")
    relays = F.ceil(F.col("n") / F.lit(ASKERS)).cast("long")
    asked = (
        found.withColumn("n", F.count("*").over(every)).withColumn("first", F.min(F.struct("low", "report")).over(every))
        # The bucket of the first document alone has nothing to remove.
        .where(((F.col("n") > 1) & (F.col("low") > F.col("first.low"))) | (F.col("report") % 2 == 1))
        .where(F.col("first.low") < NO_DOCUMENT)
        .select(
            # The bucket of the first document and the relay in one number.
            (F.shiftleft(F.floor(F.col("first.report") / 2), 32) + F.pmod(F.xxhash64(bucket_of), relays)).alias("relay"),
            bucket_of.alias("asker"), "w", F.col("first.low").alias("first"),
        )
    )

    def documents(texts: pa.Table, ids: pa.ChunkedArray) -> Bucket:
        return read_bucket(texts.filter(pc.is_in(texts.column("id"), ids.combine_chunks().unique())))

    def to_relays(left: pa.Table, right: pa.Table) -> pa.Table:
        some, first = documents(left, right.column("first")), right.column("first").to_numpy()
        relay = (right.column("home").to_numpy().astype(np.int64) << 32) + right.column("number").to_numpy()
        rows = asked_passages(some, hashes(right.column("w")), relay, size, first)
        return pa.Table.from_pylist([dict(zip(sent.names, r)) for r in rows], sent)

    def to_buckets(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = asked_passages(read_bucket(left), hashes(right.column("w")), right.column("asker").to_numpy(), size)
        return pa.Table.from_pylist([dict(zip(answers.names, r)) for r in rows], answers)

    sent = pa.schema([("relay", pa.int64()), ("id", pa.int64()), ("text", pa.string())])
    answers = pa.schema([("bucket", pa.int32()), ("id", pa.int64()), ("text", pa.string())])
    homes = asked.select("relay", "w", "first").distinct().select(
        F.shiftright("relay", 32).cast("int").alias("home"),
        F.col("relay").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("number"), "w", "first",
    )
    relayed = dealt.groupBy("bucket").cogroup(homes.groupBy("home")).applyInArrow(to_relays, "relay long, id long, text string")
    passages = (
        relayed.groupBy("relay").cogroup(asked.select("relay", "asker", "w").groupBy("relay"))
        .applyInArrow(to_buckets, "bucket int, id long, text string")
    )

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        bucket = read_bucket(left)
        masks = removed_words(bucket, read_bucket(right), size)
        spans, kept = [], []
        for words, mask in zip(bucket.words, masks):
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            spans.append([{"first": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            kept.append(b" ".join([x for x, gone in zip(words, mask.tolist()) if not gone] if len(edges) else words).decode())
        ids = pa.array([None if n else i for i, n in zip(bucket.ids.tolist(), left.column("no_id").to_pylist())], pa.int64())
        return pa.table({
            id_column: ids,
            "n_words": pa.array([len(m) for m in masks], pa.int64()),
            "n_removed": pa.array([int(m.sum()) for m in masks], pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array(kept, pa.string()),
        })

    schema = f"`{id_column}` long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept string"
    return dealt.groupBy("bucket").cogroup(passages.groupBy("bucket")).applyInArrow(remove, schema)
