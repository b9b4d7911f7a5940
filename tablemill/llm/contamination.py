"""Benchmark decontamination by normalised word windows, in native expressions only.

The windows of the benchmark items are the hash set. Their number is measured: below a
bound their parts are broadcast, beyond it the same join is shuffled. A hit of hashes is
verified on the words themselves.

A window of ``n`` words contains a part of ``n - n // 2 + 1`` words at one of every
``n // 2`` word positions. So documents are probed at every ``n // 2``-th position only,
the benchmark's windows are entered with the parts at all their offsets, and each probe
carries the few words around it for the verification. Nothing of a document is shuffled
but its verified hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col

WINDOW = 10
# What stands between words, after the lower-casing of A-Z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# So many parts of windows may be broadcast, about 200 bytes each.
BROADCAST_PARTS = 500_000


def words(text: Column) -> Column:
    """Normalised words; a null text has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, GAP + "+", -1), lambda w: w != "")


def row_key(id_column: str, text_column: str) -> Column:
    """Tells rows apart that share an id but not the text."""
    return F.xxhash64(col(id_column), col(text_column))


def _step(n: int) -> int:
    return max(1, n // 2)


def benchmark_windows(benchmark: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """Distinct ``item``, ``n``, ``gram``: every window of ``size`` words of an item, or
    all words of a shorter one. Items without words have none."""
    items = benchmark.select(
        col(id_column).cast("string").alias("item"), words(col(text_column)).alias("w")
    ).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(size))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))
    return items.select("item", n.alias("n"), F.explode(grams).alias("gram")).distinct()


def window_hits(
    documents: DataFrame, grams: DataFrame, lengths: list[int], broadcast: bool
) -> DataFrame:
    """Verified occurrences ``doc``, ``key``, ``at``, ``n``, ``gram`` of the windows in
    documents of columns ``doc``, ``key``, ``w``."""
    hits = None
    for n in lengths:
        step = _step(n)
        part = n - step + 1
        probe = F.transform(
            F.sequence(F.lit(1), F.size("w") - part + 1, F.lit(step)),
            lambda i: F.struct(
                i.alias("i"),
                F.xxhash64(F.slice("w", i, part)).alias("h"),
                F.slice("w", F.greatest(i - (step - 1), F.lit(1)), part + 2 * (step - 1)).alias("near"),
            ),
        )
        probes = documents.where(F.size("w") >= n).select("doc", "key", F.explode(probe).alias("p"))
        parts = (
            grams.where(F.col("n") == n).select("gram").distinct()
            .select(
                "gram",
                F.posexplode(
                    F.transform(
                        F.sequence(F.lit(1), F.lit(step)), lambda o: F.xxhash64(F.slice("gram", o, part))
                    )
                ).alias("offset", "h"),
            )
        )
        parts = F.broadcast(parts) if broadcast else own_exchange(parts)
        at = F.col("p.i") - F.col("offset")
        inside = at - F.greatest(F.col("p.i") - (step - 1), F.lit(1)) + 1
        found = (
            probes.join(parts, F.col("p.h") == parts["h"])
            .where(at >= 1)
            .where(F.slice("p.near", F.greatest(inside, F.lit(1)), n) == F.col("gram"))
            .select("doc", "key", at.alias("at"), F.lit(n).alias("n"), "gram")
        )
        hits = found if hits is None else hits.unionByName(found)
    return hits


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_parts: int = BROADCAST_PARTS,
) -> DataFrame:
    """Per document row: id, ``key``, ``n_words``, ``hit_words`` (positions from 1 of the
    words inside any window, sorted) and ``items`` (ids as text, sorted).

    A null or empty text has no words and no hits. Rows that repeat id and text each get
    their row; rows that share only the id are told apart. Null ids are ids. An empty
    benchmark hits nothing. Other columns are not read. Lists are as long as one
    document and the benchmark at most.
    """
    grams = staged(benchmark_windows(benchmark, size, item_id, item_text), "windows")
    # One row per window length: at most ``size`` rows.
    counted = grams.select("n", "gram").distinct().groupBy("n").count().collect()
    rows = documents.select(
        col(id_column).alias("doc"), row_key(id_column, text_column).alias("key"), col(text_column).alias("t")
    )
    totals = rows.select("doc", "key", F.size(words(F.col("t"))).cast("long").alias("n_words"))
    if not counted:
        none = F.array()
        return totals.select(
            F.col("doc").alias(id_column), "key", "n_words",
            none.cast("array<int>").alias("hit_words"), none.cast("array<string>").alias("items"),
        )
    lengths = sorted(r["n"] for r in counted)
    broadcast = sum(r["count"] * _step(r["n"]) for r in counted) <= broadcast_parts
    hits = window_hits(rows.select("doc", "key", words(F.col("t")).alias("w")), grams, lengths, broadcast)
    hits = staged(hits.distinct(), "hits")
    places = hits.groupBy("doc", "key").agg(
        F.sort_array(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        F.collect_set(F.struct("at", "n")), lambda x: F.sequence(x["at"], x["at"] + x["n"] - 1)
                    )
                )
            )
        ).alias("hit_words")
    )
    items = (
        hits.select("doc", "key", "gram").join(grams.select("item", "gram"), "gram")
        .groupBy("doc", "key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    same = [F.col("a.key") == F.col("b.key"), F.col("a.doc").eqNullSafe(F.col("b.doc"))]
    found = places.alias("a").join(items.alias("b"), same).select("a.doc", "a.key", "hit_words", "items")
    return totals.alias("a").join(own_exchange(found).alias("b"), same, "left").select(
        F.col("a.doc").alias(id_column),
        F.col("a.key").alias("key"),
        "n_words",
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def without_hits(text: Column, hit_words: Column) -> Column:
    """The text without its hit words, each with the gap before it; what follows the last
    word stays. Hits are positions from 1."""
    text = F.coalesce(text, F.lit(""))
    lead = GAP.replace(r"\x40", "").replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(text, F.lit(f"{lead}*{word}"), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.array_contains(hit_words, i + 1))
    return F.concat(F.array_join(kept, ""), F.regexp_extract(text, f"({lead}*)$", 1))


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """Documents, with their columns, that no benchmark window occurs in; with
    ``remove="spans"`` all documents, without the words inside windows."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"cannot remove {remove!r}")
    hits = contamination(documents, benchmark, id_column=id_column, text_column=text_column, **options)
    hits = (
        hits.where(F.size("hit_words") > 0)
        .select(col(id_column).alias("__doc"), F.col("key").alias("__key"), F.col("hit_words").alias("__hits"))
        .dropDuplicates(["__doc", "__key"])
    )
    names = documents.columns
    doc, text = (F.col(f"c{names.index(c)}") for c in (id_column, text_column))
    plain = documents.select([col(c).alias(f"c{i}") for i, c in enumerate(names)])
    same = [F.xxhash64(doc, text) == F.col("__key"), doc.eqNullSafe(F.col("__doc"))]
    given = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    if remove == "documents":
        return plain.join(own_exchange(hits), same, "left_anti").select(given)
    cleaned = F.when(F.col("__key").isNull(), text).otherwise(without_hits(text, F.col("__hits")))
    given[names.index(text_column)] = cleaned.alias(text_column)
    return plain.join(own_exchange(hits), same, "left").select(given)
