"""Removal of lines whose template recurs across documents: a fixed-depth parse tree.

Levels of the tree: number of tokens, then the leading tokens; a token with a digit is a
variable field ``<*>`` already there. A leaf holds the templates of its lines. A line
belongs to the template it agrees with in most positions, if in enough of them; the
positions that differ become variable fields. A line without such a template founds one.

The upper levels are a key of plain expressions, so the tree is spread over the cluster
by leaf. Only leaves that lines of two documents share are parsed, and equal lines enter
as one. A leaf too large for one task is parsed in parts whose templates are then merged
the same way, hot or not.

A template counts as recurring where it stands in ``contexts`` documents that are not
copies: with as many different texts, or as many neighbourhoods (the line before and
after, variable fields masked). An inner line of a block has one neighbourhood wherever
the block stands, so the texts decide there. Documents whose whole text is equal have one
text, so copies are left to the operators for duplicates. The document
with the smallest id keeps its lines of a template, so nothing vanishes from the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col

DEPTH = 3
AGREE = 0.8
CONTEXTS = 3
FIELD = "<*>"
# Distinct lines of a leaf that one task parses.
PART_LINES = 5_000


def tokens(line: Column) -> Column:
    """Tokens between white space, those with a digit as variable fields."""
    fields = F.when(line.rlike("[0-9]"), F.regexp_replace(line, r"\S*[0-9]\S*", FIELD)).otherwise(line)
    return F.filter(F.split(fields, r"\s+", -1), lambda t: t != "")


def leaf_of(t: Column) -> Column:
    return F.xxhash64(F.size(t), F.slice(t, 1, DEPTH))


class Leaf:
    """Templates of a leaf in the order they were founded.

    All lines of a leaf share their leading tokens. As most positions must agree, a template can
    only take a line if it shares a constant behind those or has a variable field there: an
    index by constants gives these templates, and no other is looked at.
    """

    def __init__(self, agree: float):
        self.agree = agree
        self.words: dict[str, int] = {FIELD: 0}
        self.table = np.empty((0, 0), np.int64)
        self.size = 0
        self.by_constant: dict[tuple[int, int], list[int]] = {}
        self.with_fields: set[int] = set()

    def candidates(self, row: np.ndarray) -> np.ndarray:
        """Templates that may take a line, in the order they were founded."""
        shared = len(row) - DEPTH
        if shared <= 0 or DEPTH >= self.agree * len(row):
            return np.arange(self.size)
        found = set(self.with_fields)
        for at in range(DEPTH, len(row)):
            if row[at]:
                found.update(self.by_constant.get((at, int(row[at])), ()))
        return np.array(sorted(found), np.int64)

    def place(self, line: str) -> int:
        """Number of the template of a masked line; the template learns from it."""
        row = np.array([self.words.setdefault(t, len(self.words)) for t in line.split(" ")], np.int64)
        if self.size == 0:
            self.table = np.zeros((16, len(row)), np.int64)
        numbers = self.candidates(row)
        if len(numbers):
            known = self.table[numbers]
            # Variable fields agree with everything, but constants decide ties.
            same = (known == row) & (known != 0)
            score = (same | (known == 0)).mean(1)
            best = int(np.lexsort((-same.sum(1), -score))[0])
            if score[best] >= self.agree and same[best].any():
                number = int(numbers[best])
                self.table[number] = np.where(known[best] == row, row, 0)
                if not self.table[number, DEPTH:].all():
                    self.with_fields.add(number)
                return number
        if self.size == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.size] = row
        for at in range(DEPTH, len(row)):
            if row[at]:
                self.by_constant.setdefault((at, int(row[at])), []).append(self.size)
            else:
                self.with_fields.add(self.size)
        self.size += 1
        return self.size - 1

    def templates(self) -> list[str]:
        names = list(self.words)
        return [" ".join([names[i] for i in row]) for row in self.table[: self.size].tolist()]


def parse(lines: list[str], agree: float) -> list[str]:
    """Template of each line; the result does not depend on their order."""
    leaf = Leaf(agree)
    order = sorted(range(len(lines)), key=lines.__getitem__)
    number = {i: leaf.place(lines[i]) for i in order}
    names = leaf.templates()
    return [names[number[i]] for i in range(len(lines))]


def leaf_templates(distinct: DataFrame, agree: float, part_lines: int) -> DataFrame:
    """``line``, ``template`` of distinct rows ``leaf``, ``line``."""
    sizes = distinct.groupBy("leaf").agg(F.ceil(F.count("*") / F.lit(part_lines)).cast("long").alias("parts"))
    dealt = distinct.join(own_exchange(sizes), "leaf").withColumn("part", F.pmod(F.xxhash64("line"), "parts"))

    def once(table: pa.Table) -> pa.Table:
        lines = table.column("line").to_pylist()
        return table.select(["leaf", "line"]).append_column("template", pa.array(parse(lines, agree), pa.string()))

    schema = "leaf long, line string, template string"
    first = staged(dealt.select("leaf", "part", "parts", "line").groupBy("leaf", "part").applyInArrow(once, schema), "templates")
    # Templates of the parts of a leaf, merged by the same rule.
    large = own_exchange(sizes.where("parts > 1").select("leaf"))
    parts = first.join(large, "leaf", "left_semi").select("leaf", F.col("template").alias("line")).distinct()
    merged = parts.groupBy("leaf").applyInArrow(once, schema).select(
        "leaf", F.col("line").alias("template"), F.col("template").alias("merged")
    )
    return first.join(own_exchange(merged), ["leaf", "template"], "left").select(
        "leaf", "line", F.coalesce("merged", "template").alias("template")
    )


def _lines(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One row per line that has a token: ``doc``, ``h`` (of the masked line), ``leaf``,
    ``around`` (hash of the neighbourhood), ``body`` (hash of the whole text)."""
    lines = F.split(F.coalesce(col(text_column), F.lit("")), "\n", -1)
    each = df.select(
        col(id_column).alias("doc"),
        F.xxhash64(col(text_column)).alias("body"),
        F.transform(lines, lambda x: tokens(x)).alias("t"),
    )
    hashes = F.transform("t", lambda t: F.xxhash64(t))
    each = each.select("doc", "body", "t", F.concat(F.array(F.lit(0).cast("long")), hashes, F.array(F.lit(1).cast("long"))).alias("h"))
    rows = F.transform(
        "t",
        lambda t, i: F.struct(
            F.get("h", i + 1).alias("h"),
            leaf_of(t).alias("leaf"),
            F.xxhash64(F.get("h", i), F.get("h", i + 2)).alias("around"),
            F.size(t).alias("n"),
        ),
    )
    return each.select("doc", "body", F.inline(rows)).where("n > 0")


def recurring_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    contexts: int = CONTEXTS,
    agree: float = AGREE,
    part_lines: int = PART_LINES,
) -> DataFrame:
    """Lines to drop: ``doc``, ``h`` (hash of the tokens), ``template``, ``n_docs``,
    ``n_contexts`` (different texts or neighbourhoods, whichever are more). Where the document is
    the smallest of the template, they stay."""
    lines = staged(_lines(df, id_column, text_column), "lines")
    # A template can only recur if its leaf does: other lines are not read again.
    def leaves_with(name: str) -> DataFrame:
        """Leaves in two documents, with enough values of a column."""
        each = lines.where("doc is not null").groupBy("leaf", name).agg(F.min("doc").alias("a"), F.max("doc").alias("b"))
        return (
            each.groupBy("leaf").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n"))
            .where((F.col("n") >= contexts) & (F.col("a") != F.col("b"))).select("leaf")
        )

    shared = staged(leaves_with("around").unionByName(leaves_with("body")).distinct(), "shared")
    wanted = staged(
        lines.join(own_exchange(shared), "leaf", "left_semi").select("doc", "h", "leaf", "around", "body").distinct(), "wanted"
    )
    texts = df.select(
        F.explode(F.transform(F.split(F.coalesce(col(text_column), F.lit("")), "\n", -1), tokens)).alias("t")
    ).where(F.size("t") > 0)
    distinct = staged(
        texts.select("t", leaf_of(F.col("t")).alias("leaf")).join(shared, "leaf", "left_semi")
        .select("leaf", F.xxhash64("t").alias("h"), F.array_join("t", " ").alias("line")).distinct(),
        "distinct",
    )
    templates = staged(leaf_templates(distinct.select("leaf", "line"), agree, part_lines), "leaves")
    named = distinct.join(own_exchange(templates), ["leaf", "line"]).select("leaf", "h", "template")
    seen = staged(wanted.join(own_exchange(named), ["h", "leaf"]), "seen")
    counts = _counted(seen.where("doc is not null"))
    recurring = counts.where((F.col("n_docs") >= contexts) & (F.col("n_contexts") >= contexts))
    found = seen.join(own_exchange(recurring), ["leaf", "template"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return found.select("doc", "h", "template", "n_docs", "n_contexts")


def _counted(seen: DataFrame) -> DataFrame:
    """Documents, neighbourhoods and texts per template, each counted after a distinct, so that
    no set of a hot template is held in one place."""
    docs = seen.select("leaf", "template", "doc").distinct().groupBy("leaf", "template").agg(
        F.count("*").alias("n_docs"), F.min("doc").alias("keeper")
    )
    def different(name: str) -> DataFrame:
        return seen.select("leaf", "template", name).distinct().groupBy("leaf", "template").agg(F.count("*").alias("n"))

    counts = different("around").unionByName(different("body"))
    most = counts.groupBy("leaf", "template").agg(F.max("n").alias("n_contexts"))
    return docs.join(own_exchange(most), ["leaf", "template"])


def drop_recurring_lines(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows of ``df`` with ``text`` less its recurring lines, and ``n_lines`` and
    ``n_dropped``.

    A null text stays null and has no line; an empty one has one empty line. Lines without
    a token are never dropped. The other columns are kept, but for those named like the
    two counts. Rows that share an id are one
    document; rows without an id lose recurring lines but neither count nor keep them.
    """
    gone = (
        recurring_lines(df, id_column, text_column, **options)
        .groupBy("doc").agg(F.collect_set("h").alias("gone"))
    )
    names = [c for c in df.columns if c not in ("n_lines", "n_dropped")]
    place = f"c{names.index(text_column)}"
    plain = df.select([col(c).alias(f"c{i}") for i, c in enumerate(names)])
    ident = F.col(f"c{names.index(id_column)}")
    joined = plain.join(own_exchange(gone), ident.eqNullSafe(F.col("doc")), "left")
    lines = F.split(F.coalesce(F.col(place), F.lit("")), "\n", -1)
    # Only documents that lose a line are taken apart.
    kept = F.when(
        F.col("gone").isNotNull(),
        F.filter(lines, lambda x: ~F.array_contains("gone", F.xxhash64(tokens(x)))),
    )
    done = joined.select(
        *plain.columns,
        F.when(F.col(place).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n"),
        kept.alias("kept"),
    )
    text = F.when(F.col("kept").isNull(), F.col(place)).otherwise(F.array_join("kept", "\n"))
    return done.select(
        *[text.alias(c) if c == text_column else F.col(f"c{i}").alias(c) for i, c in enumerate(names)],
        F.col("n").alias("n_lines"),
        F.when(F.col("kept").isNull(), 0).otherwise(F.col("n") - F.size("kept")).cast("long").alias("n_dropped"),
    )
