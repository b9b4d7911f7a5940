"""Quality rules against a plain version, with edge cases."""

import re
from collections import Counter

from conftest import SMALL

from tablemill.llm import quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, k0 string, n_words string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    under = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(under)
    ), len(lines)


def leading(v):
    shift = max(v.bit_length() - 6, 0)
    return v >> shift << shift


def brute(rows, enough):
    """Fences from sorted lists instead of sketches."""
    told = []
    for r in rows:
        (n, chars, symbols, same, repeated), lines = counts(r[1])
        failed = n < 50 or 100 * repeated > 50 * n
        values = None if failed else (1000 * chars // n, 1000 * symbols // n, 1000 * repeated // n, 1000 * same // lines)
        told.append((r[0], (n, chars, symbols, same, repeated), failed, values, r[2], r[3]))
    out = []
    for doc, have, failed, values, lang, source in told:
        kept = not failed
        if kept:
            group = [t[3] for t in told if t[3] and (t[4], t[5]) == (lang, source)]
            if len(group) < enough:
                group = [t[3] for t in told if t[3] and t[4] == lang]
            if len(group) < enough:
                group = [t[3] for t in told if t[3]]
            for i, least in enumerate((50, 10, 50, 75)):
                column = sorted(leading(v[i]) for v in group)
                q1, q2, q3 = (column[-(-len(column) * k // 4) - 1] for k in (1, 2, 3))
                kept = kept and abs(values[i] - q2) <= 6 * max(q3 - q1, least)
        out.append((doc, *have, failed, kept))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def check(spark, rows, enough):
    df = spark.createDataFrame([(*r[:4], "x", "y") for r in rows], SCHEMA).repartition(5)
    got = [tuple(r) for r in quality_rules.judge_quality(df, enough=enough).collect()]
    assert sorted(got, key=key) == sorted(brute(rows, enough), key=key)


def test_edge_cases(spark):
    prose = "alpha beta gamma delta " * 3 + " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \t\n", "a", "a b", "a b a b a b", "x\nx\n\nx\n \n", "Ünïcödé 😀 \x00     a",
             prose, prose, prose.replace(" ", "\n"), prose + " ###" * 40, "one " * 400, prose * 200, "z" * 100_000, "q " * 49 + "é"]
    rows = [(i, t, ("en", None, "de")[i % 3], (None, "s", "t")[i % 2]) for i, t in enumerate(texts)]
    rows += [rows[8], (None, prose, "en", "s"), (3, prose, None, None)]
    for enough in (1, 3, 1000):
        check(spark, rows, enough)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert quality_rules.judge_quality(df).count() == 0
    assert quality_rules.drop_poor(df).columns == df.columns


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    check(spark, rows, 20)


def test_sketches_merge(spark):
    """Sketches of parts, merged, are the sketch of the whole."""
    df = spark.range(10_000).selectExpr("id % 3 as g", "id * id as v")
    whole = quality_rules.sketches(df, [], {"v": df.v})
    parts = quality_rules.merged(quality_rules.sketches(df, ["g"], {"v": df.v}), [])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))
    middle = quality_rules.quartiles(whole, []).first().q2
    assert 4999**2 * 31 / 32 <= middle <= 4999**2


def test_hot_group_and_filter(spark):
    """A group with a third of the rows; documents of a failing id go, all columns stay."""
    prose = " ".join(f"word{i % 97}" for i in range(120))
    rows = [(i, f"{prose} tail{i}", "en", "hot" if i % 3 else f"s{i % 20}", "a", "b") for i in range(600)]
    rows += [(1000, prose + " |" * 60, "en", "hot", "a", "b"), (1001, "short", "en", "hot", "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = quality_rules.drop_poor(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == set(range(600))


def test_native(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = quality_rules.text_counts(df, "text", [df.doc_id])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
