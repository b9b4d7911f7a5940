"""Null ids, repeated rows and empty tables of the earlier operators."""

import pytest

from tablemill.llm import contamination, fast_similarity, line_templates, repeated_passages, token_counts, warc
from tablemill.llm.queries import vocabulary

WORDS = " ".join(f"w{i}" for i in range(30))


def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, id string, n long")


def test_token_counts_of_odd_tables(spark):
    import public_tokenizers

    def counts(df):
        return token_counts.section_token_counts(df, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()

    rows = [(None, "a b\nc"), (1, "a b\nc"), (1, "a b\nc"), (1, None), (2, "")]
    found = counts(docs(spark, rows))
    assert [r.doc_id for r in found] == [None, 1, 1, 1, 2]
    assert len({(r.n_tokens, tuple(r.section_tokens)) for r in found[:3]}) == 1
    assert [(r.n_tokens, r.n_sections) for r in found[3:]] == [(0, 1), (0, 1)]
    assert counts(docs(spark, rows).limit(0)) == []


def test_repeated_passages_of_repeated_ids(spark):
    rows = [(1, WORDS), (1, WORDS), (2, WORDS), (3, None), (3, "")]
    found = repeated_passages.repeated_passages(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found) == [(1, 30, 0), (1, 30, 0), (2, 30, 30), (3, 0, 0), (3, 0, 0)]


def test_near_duplicates_of_repeated_rows(spark):
    rows = [(4, WORDS), (4, WORDS), (5, WORDS + " tail"), (6, None), (7, "")]
    found = fast_similarity.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(4, 4, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True)]
    assert fast_similarity.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_lines_of_rows_without_id(spark):
    line = "this very line returns in many texts"
    rows = [(i, f"{line}\nown {chr(97 + i)} {chr(98 + i)} text") for i in range(5)] + [(None, f"{line}\nnobody owns this")] * 2
    found = line_templates.drop_recurring_lines(docs(spark, rows)).collect()
    assert sorted(line in r.text for r in found) == [False] * 6 + [True]
    assert [r.n_dropped for r in found if r.doc_id is None] == [1, 1] and [r.n_dropped for r in found if r.doc_id == 0] == [0]


def test_contamination_of_rows_without_id(spark):
    items = spark.createDataFrame([("b", "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), ("a", "W29"), (None, None), ("c", "")], "item_id string, text string")
    rows = [(None, WORDS), (None, WORDS), (1, "clean text"), (1, None)]
    found = contamination.contamination(docs(spark, rows), items).collect()
    assert sorted((r.doc_id is None, len(r.hit_words), list(r.items)) for r in found) == [
        (False, 0, []), (False, 0, []), (True, 11, ["a", "b"]), (True, 11, ["a", "b"]),
    ]


def test_archives_of_repeated_pages(spark, tmp_path):
    page = "p" * 150
    pages = spark.createDataFrame([(1, "u", page), (2, "u", page), (3, None, page), (4, "u", None), (4, "u", None)], "page_id int, url string, html string")
    warc.write_warc(pages, f"{tmp_path}/w")
    found = warc.archive_index(warc.read_warc(spark, f"{tmp_path}/w")).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found if r.page_id < 4) == [
        (1, "response", None), (2, "revisit", 1), (3, "revisit", 1),
    ]
    assert [(r.record_type, r.payload_bytes) for r in found if r.page_id == 4] == [("response", 0)] * 2


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_removal_keeps_the_columns(spark, remove):
    items = spark.createDataFrame([("a", "w3 w4")], "item_id string, text string")
    df = docs(spark, [(None, WORDS), (1, "clean"), (None, None)])
    found = contamination.decontaminate(df, items, remove)
    assert found.columns == df.columns and found.count() == (2 if remove == "documents" else 3)
