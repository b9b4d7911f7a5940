"""Token counts against a version that follows the bytes of every token."""

import public_tokenizers
import pytest
from conftest import SMALL

from tablemill.llm import token_counts
from tablemill.llm.queries import QUERIES, vocabulary

RANKS = vocabulary("byte_bpe_50k.tiktoken")


def plain_counts(encoding, text):
    """Tokens of every line, and how many lie in several: each byte of a token counts as
    the character it belongs to, each character once."""
    lines = text.split("\n")
    section = [i for i, x in enumerate(lines) for _ in range(len(x) + (i < len(lines) - 1))]
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    counts, crossing, at = [0] * len(lines), 0, 0
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        held = [section[c] for c in dict.fromkeys(owner[at : at + size])]
        at += size
        counts[min(set(held), key=lambda s: (-held.count(s), s))] += 1
        crossing += len(set(held)) > 1
    assert at == len(owner)
    return counts, crossing


@pytest.fixture(scope="module")
def encoding():
    return token_counts.load_encoding(RANKS, public_tokenizers.PATTERN)[0]


def test_query_counts_every_line_of_every_document(spark, encoding):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op2_token_counts"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        counts, crossing = plain_counts(encoding, texts[r.doc_id])
        assert (list(r.section_tokens), r.n_crossing, r.n_tokens) == (counts, crossing, sum(counts))


def test_tokens_over_several_lines_and_parts_of_characters(spark, encoding):
    texts = ["a\n\n\n\nb", "x \n \n  y", "日本語\n😀😀\n‍", "\n" * 40 + "z", "é́\n" * 5, "    \n\t\n    code", ""]
    frame = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in token_counts.section_token_counts(frame, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        assert (list(got[i].section_tokens), got[i].n_crossing) == plain_counts(encoding, text)
    assert any(r.n_crossing for r in got.values())
