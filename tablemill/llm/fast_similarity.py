"""Near-duplicates of word shingles by fast similarity sketching.

A sketch of ``t`` coordinates is filled in rounds. In round ``i`` every shingle falls into
one bin at random with the value ``i`` plus a random fraction; from round ``t`` on all fall
into bin ``i - t``. Each bin keeps its smallest value; a round starts only while a bin is
empty, so every coordinate is filled after ``2 t`` rounds at the latest, usually after a
few, and coordinates agree with the probability of the Jaccard similarity.

1. Documents with the same set are one class; only classes are compared.
2. Bands of ``rows`` coordinates are hashed. Classes that share a band are compared by
   sketch inside the task that holds the band; spanning edges of those that may be similar
   leave it, never all pairs. Their components are the candidate groups.
3. Every class of a group is read again, and inside a group all pairs not yet joined are
   counted exactly on the full sets.

Hot groups are split into blocks, and pairs of blocks go to different tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tablemill.llm.components import connected_components
from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col

SHINGLE = 5
SIMILAR = 75  # percent
BINS = 128
ROWS_PER_BAND = 4
# Sketches that agree this much may be similar: more than five standard deviations
# below the similarity of a link.
MAYBE = 0.54
# Members of a band, and bytes of sets of a group, that one task compares at once.
BAND_BLOCK = 2048
SET_BLOCK_BYTES = 8_000_000
ROWS_AT_ONCE = 500

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word: A-Z lower-cased, split at ASCII white space."""
    from xxhash import xxh3_64_intdigest

    found = (text or "").encode().translate(LOWER).split()
    return np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words are one shingle, none no set."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(GOLDEN) + words[i : n - width + 1 + i])
    return np.unique(out)


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The filled coordinates of a set that is not empty, as 64-bit values: the round in
    the upper bits, the random fraction below."""
    full = np.iinfo(np.uint64).max
    out = np.full(bins, full, np.uint64)
    fraction = np.uint64((1 << 56) - 1)
    for i in range(2 * bins):
        seed = np.uint64((i * GOLDEN + 0x1234567) % (1 << 64))
        h = mix(shingles ^ mix(np.array([seed]))[0])
        place = h % np.uint64(bins) if i < bins else np.full(len(h), i - bins, np.uint64)
        value = (np.uint64(i) << np.uint64(56)) | (mix(h + np.uint64(GOLDEN)) & fraction)
        np.minimum.at(out, place.astype(np.int64), value)
        if not (out == full).any():
            break
    return out


def band_hashes(coordinates: np.ndarray, rows: int = ROWS_PER_BAND) -> np.ndarray:
    """One hash per band, different for equal values in different bands."""
    table = coordinates.reshape(-1, rows)
    out = np.arange(len(table), dtype=np.uint64) * np.uint64(GOLDEN)
    for i in range(rows):
        out = mix(out ^ table[:, i]) + np.uint64(i)
    return mix(out)


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def signatures(df: DataFrame) -> DataFrame:
    """``id``, ``n_shingles``, ``k1``/``k2`` (128 bits of the set), ``bands``, ``bytes``
    (one byte per coordinate) of rows ``id``, ``text``."""
    schema = df.select("id").schema
    for name, kind in (("n_shingles", "long"), ("k1", "long"), ("k2", "long"), ("bands", ArrayType(LongType())), ("bytes", "binary")):
        schema = schema.add(name, kind)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                count, k1, k2, bands, low = [], [], [], [], []
                for text in part.column(1).to_pylist():
                    s = shingle_set(word_hashes(text))
                    count.append(len(s))
                    with np.errstate(over="ignore"):
                        k1.append(int(np.add.reduce(mix(s)).astype(np.int64)))
                        k2.append(int(np.bitwise_xor.reduce(mix(s + np.uint64(GOLDEN))).astype(np.int64)))
                        if len(s):
                            c = sketch(s)
                            bands.append(band_hashes(c).view(np.int64).tolist())
                            low.append((c & np.uint64(255)).astype(np.uint8).tobytes())
                        else:
                            bands.append(None)
                            low.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)


def runs_of(batches, key_columns: int):
    """Tables of equal leading columns from sorted batches; a run may span batches."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        n = table.num_rows
        if n == 0:
            continue
        change = np.zeros(n, bool)
        for i in range(key_columns):
            key = table.column(i).to_numpy()
            change[1:] |= key[1:] != key[:-1]
        starts = np.flatnonzero(change)
        if len(starts) == 0:
            rest = table
            continue
        bounds = [0, *starts.tolist()]
        table = table.combine_chunks()
        for a, b in zip(bounds, bounds[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


class Joined:
    """Union of the members of one group."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        roots = np.unique(self.root[others])
        mine = self.root[i]
        roots = roots[roots != mine]
        if len(roots):
            every = np.append(roots, mine)
            self.root[np.isin(self.root, every)] = every.min()

    def edges(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An edge of every member to the lead of its part."""
        others = np.flatnonzero(self.root != np.arange(len(ids)))
        return ids[others], ids[self.root[others]]


def _edge_batches(found):
    for a, b in found:
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _blocked(members: DataFrame, keys: list[str], blocks, ident: str) -> DataFrame:
    """Members of a group for every pair of its blocks, with ``b1`` <= ``b2`` and the own
    ``block``; a group of one block stays as it is."""
    own = F.pmod(F.xxhash64(ident), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), blocks - 1),
        lambda k: F.struct(F.least(own, k).alias("b1"), F.greatest(own, k).alias("b2")),
    )
    others = [c for c in members.columns if c not in keys and c != "blocks"]
    return members.select(*keys, own.alias("block"), *others, F.explode(pairs).alias("p")).select(
        *keys, "p.b1", "p.b2", "block", *others
    )


def candidate_edges(classes: DataFrame, maybe: float = MAYBE, block: int = BAND_BLOCK) -> DataFrame:
    """Edges ``a``, ``b`` that span the classes which share a band and whose sketches agree
    enough; ``classes`` has ``id``, ``bands``, ``bytes``."""
    bands = classes.select("id", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = bands.join(own_exchange(shared), "band").select(
        "band", "id", F.ceil(F.col("n") / F.lit(block)).cast("long").alias("blocks")
    )
    members = members.join(own_exchange(classes.select("id", "bytes")), "id").select("band", "id", "bytes", "blocks")
    dealt = _blocked(members, ["band"], F.col("blocks"), "id").select("band", "b1", "b2", "block", "id", "bytes")
    dealt = dealt.repartition("band", "b1", "b2").sortWithinPartitions("band", "b1", "b2")

    def compare(table):
        ids = table.column(4).to_numpy()
        n = len(ids)
        low = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint8).reshape(n, -1)
        least = maybe * low.shape[1]
        joined = Joined(n)
        for i in range(n - 1):
            rest = np.flatnonzero(joined.root[i + 1 :] != joined.root[i]) + i + 1
            if len(rest):
                joined.join(i, rest[(low[rest] == low[i]).sum(1) >= least])
        return joined.edges(ids)

    def run(batches):
        yield from _edge_batches(compare(t) for t in runs_of(batches, 3) if t.num_rows > 1)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def verified_edges(groups: DataFrame, texts: DataFrame, similar: int = SIMILAR, block_bytes: int = SET_BLOCK_BYTES) -> DataFrame:
    """Edges that span the classes of a candidate group linked by their full sets.

    ``groups`` has ``id``, ``grp``, ``n_shingles``; ``texts`` has ``id``, ``text``.
    """
    sizes = groups.groupBy("grp").agg(F.ceil(F.sum("n_shingles") * 8 / F.lit(block_bytes)).cast("long").alias("blocks"))
    members = groups.join(own_exchange(sizes), "grp").select("id", "grp", "blocks")
    members = texts.join(own_exchange(members), "id").select("grp", "id", "text", "blocks")

    def read(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                sets = [shingle_set(word_hashes(t)) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), _binary(sets), part.column(3)], names=["grp", "id", "items", "blocks"]
                )

    sets = members.mapInArrow(read, "grp long, id long, items binary, blocks long")
    dealt = _blocked(sets, ["grp"], F.col("blocks"), "id").select("grp", "b1", "b2", "block", "id", "items")
    dealt = dealt.repartition("grp", "b1", "b2").sortWithinPartitions("grp", "b1", "b2")

    def compare(table):
        ids = table.column(4).to_numpy()
        items = [np.frombuffer(x, np.uint64) for x in table.column(5).to_pylist()]
        n = len(ids)
        sizes = np.array([len(x) for x in items])
        joined = Joined(n)
        if n == 2:
            common = len(np.intersect1d(items[0], items[1], assume_unique=True))
            if 100 * common >= similar * (sizes.sum() - common):
                joined.join(0, np.array([1]))
            return joined.edges(ids)
        # Inverted index of the group: members of every shingle.
        owner = np.repeat(np.arange(n), sizes)
        _, number = np.unique(np.concatenate(items), return_inverse=True)
        order = np.argsort(number, kind="stable")
        owners = owner[order]
        begin = np.concatenate([[0], np.cumsum(np.bincount(number))])
        offset = np.concatenate([[0], np.cumsum(sizes)])
        for i in range(n - 1):
            if (joined.root[i + 1 :] == joined.root[i]).all():
                continue
            mine = number[offset[i] : offset[i + 1]]
            first, count = begin[mine], begin[mine + 1] - begin[mine]
            at = np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            common = np.bincount(owners[at], minlength=n)
            linked = 100 * common >= similar * (sizes + sizes[i] - common)
            linked[: i + 1] = False
            joined.join(i, np.flatnonzero(linked))
        return joined.edges(ids)

    def run(batches):
        yield from _edge_batches(compare(t) for t in runs_of(batches, 3) if t.num_rows > 1)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id reachable over links of
    75 % similarity), ``kept`` (the id is the component's).

    Null, empty and blank texts have no set and are linked with nothing. Rows that share
    an id are one document with several sets, and so in one component. Rows with the
    same set, repeated rows among them, are linked. A null id takes part by its text but
    never names a component unless it stands alone, where the component is null and the
    row kept. Other columns are not read.
    """
    rows = df.select(col(id_column).cast("long").alias("id"), col(text_column).alias("text"))
    signed = staged(signatures(rows), "sketches")
    named = signed.where("n_shingles > 0 and id is not null")
    classes = named.groupBy("k1", "k2").agg(F.min("id").alias("id"))
    # The row of the class's smallest id carries the sketch; ties are equal rows.
    lead = staged(
        named.join(own_exchange(classes.select("k1", "k2", F.col("id").alias("lead"))), ["k1", "k2"])
        .where("id = lead").dropDuplicates(["k1", "k2"]).select("id", "k1", "k2", "n_shingles", "bands", "bytes"),
        "classes",
    )
    candidates = connected_components(candidate_edges(lead))
    groups = staged(
        candidates.select(F.col("node").alias("id"), F.col("component").alias("grp"))
        .join(own_exchange(lead.select("id", "k1", "k2", "n_shingles")), "id"),
        "groups",
    )
    links = verified_edges(groups, rows)
    components = connected_components(links)
    chosen = lead.select("id", "k1", "k2").join(
        own_exchange(components.withColumnRenamed("node", "id")), "id", "left"
    ).select("k1", "k2", F.coalesce("component", "id").alias("component"))
    joined = signed.select("id", "n_shingles", "k1", "k2").join(own_exchange(chosen), ["k1", "k2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").isNull() & component.isNull()).alias("kept"),
    )
