"""Token counts of sections and fields by offset mapping.

A document is encoded once and whole, so its tokens are those a model would see.
The character spans of the tokens are interval-joined to the sections: both are sorted
intervals of one document, so the join is a binary search per document and moves no row.

Rule for a token across a boundary: it counts for the section that holds most of its
characters, for the earlier one if they hold equally many. A token that holds only part
of a character counts as lying where that character lies. So the counts of all sections
add up to the count of the document.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tablemill.spec import col

ROWS_AT_ONCE = 1000


def load_encoding(ranks_path: str, pattern: str):
    """Encoding of a rank file, and the length of every token in bytes."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, sizes


def spans(text: str, encoding, sizes) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of every token of a text."""
    ids = encoding.encode_to_numpy(text, disallowed_special=())
    data = np.frombuffer(text.encode(), np.uint8)
    # Character of every byte: continuation bytes belong to the one before.
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    ends = np.cumsum(sizes[ids])
    return character[ends - sizes[ids]], character[ends - 1]


def attribute(first: np.ndarray, last: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """Tokens per section, given the section ends in characters (rising; equal ones
    bound empty sections), and the number of tokens that cross a boundary."""
    home = np.searchsorted(ends, first, side="right")
    far = np.searchsorted(ends, last, side="right")
    crossing = np.flatnonzero(home != far)
    for i in crossing:
        edges = np.concatenate([[first[i]], ends[home[i] : far[i]], [last[i] + 1]])
        home[i] += int(np.argmax(np.diff(edges)))
    return np.bincount(home, minlength=len(ends)), len(crossing)


def _counted(df: DataFrame, ranks_path: str, pattern: str, id_column: str) -> DataFrame:
    """Counts for rows of id, text and the lengths of its sections in characters."""
    schema = (
        df.select(col(id_column)).schema.add("n_tokens", "long").add("n_chars", "long")
        .add("n_sections", "long").add("n_crossing", "long").add("section_tokens", ArrayType(LongType()))
    )

    def run(batches):
        encoding, sizes = load_encoding(ranks_path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = []
                for text, lengths in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    ends = np.cumsum(lengths, dtype=np.int64)
                    if text:
                        first, last = spans(text, encoding, sizes)
                        counts, crossing = attribute(first, last, ends)
                        rows.append((len(first), len(text), len(ends), crossing, counts.tolist()))
                    else:
                        rows.append((0, 0, len(ends), 0, [0] * len(ends)))
                columns = list(zip(*rows))
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    names=schema.names,
                )

    return df.mapInArrow(run, schema)


def section_token_counts(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Tokens of every line of every whole text; a line includes its line break.

    Result per row: id, ``n_tokens``, ``n_chars``, ``n_sections``, ``n_crossing`` (tokens
    across a boundary) and ``section_tokens`` in order of the lines. A null text is an
    empty one: one empty section, no token. An empty last line is an empty section.
    Repeated rows and null ids stay; other columns are not read.
    """
    text = F.coalesce(col(text_column), F.lit(""))
    lines = F.split(text, "\n", -1)
    lengths = F.transform(lines, lambda x, i: F.length(x) + F.when(i < F.size(lines) - 1, 1).otherwise(0))
    return _counted(_bounded(df, id_column, text, lengths), ranks_path, pattern, id_column)


def field_token_counts(
    df: DataFrame, fields: list[str], joiner: str, ranks_path: str, pattern: str, id_column: str
) -> DataFrame:
    """The same for the fields of a row, encoded together with ``joiner`` between them;
    a joiner belongs to the field before it. A null field is empty."""
    texts = [F.coalesce(col(f).cast("string"), F.lit("")) for f in fields]
    texts = [t if i == len(texts) - 1 else F.concat(t, F.lit(joiner)) for i, t in enumerate(texts)]
    lengths = F.array([F.length(t) for t in texts])
    return _counted(_bounded(df, id_column, F.concat(*texts), lengths), ranks_path, pattern, id_column)


def _bounded(df, id_column, text, lengths) -> DataFrame:
    return df.select(col(id_column), text.alias("__text"), lengths.alias("__lengths"))
