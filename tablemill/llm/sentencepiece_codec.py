"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes symbols (its characters, blanks as ``▁``). The agenda holds all adjacent
pairs whose concatenation is a piece, ordered by score, then position; the best pair is
merged, its neighbours enter the agenda, until it is empty. What is left and is no piece
becomes byte pieces. The agendas of all new words of a batch are rows of one matrix and are
worked off side by side; only words that are very long have an
agenda of their own.

No piece of such a vocabulary has ``▁`` behind another character (checked on loading),
so no merge crosses from a word into the blank before the next one: words are encoded
one by one and remembered, and a text is put together from their ids. Every word an Arrow
batch brings that is not remembered is checked against the sentencepiece library; a difference is
an error, not a result.
"""

from __future__ import annotations

import heapq
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tablemill.spec import col

BLANK = "▁"
NEVER = float("inf")
# Words of fewer characters have their agenda in the matrix, others in a heap.
SHORT = 48
# Characters of words remembered by a worker: bounds its memory. Beyond it the less used half goes.
REMEMBERED = 4_000_000
# Characters of text worked off at once, and words of a matrix.
CHARACTERS_AT_ONCE = 2_000_000
WORDS_AT_ONCE = 8192
# New words that the library gets as one text.
PACKED = 64


def merge_short(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """Agenda as a list of pair costs: its first minimum is the best pair furthest left."""
    get = cost.get
    agenda = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
    while agenda:
        best = min(agenda)
        if best == NEVER:
            break
        i = agenda.index(best)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        del agenda[i]
        if i < len(agenda):
            agenda[i] = get(symbols[i] + symbols[i + 1], NEVER)
        if i:
            agenda[i - 1] = get(symbols[i - 1] + symbols[i], NEVER)
    return symbols


def merge_long(symbols: list[str], cost: dict[str, float]) -> list[str]:
    """Agenda as a heap over a linked list of symbols: n log n for words of any length."""
    n = len(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            pair = symbols[i] + symbols[after[i]]
            if pair in cost:
                heapq.heappush(agenda, (cost[pair], i, pair))

    for i in range(n):
        offer(i)
    while agenda:
        _, i, pair = heapq.heappop(agenda)
        j = after[i] if symbols[i] else n
        # Stale unless the two symbols still stand side by side.
        if j >= n or symbols[i] + symbols[j] != pair:
            continue
        symbols[i], symbols[j] = pair, ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [s for s in symbols if s]


def words_of(text: str) -> list[str]:
    """Parts that no merge crosses, each without the one blank that leads it.

    One blank is put before a text that is not empty. A run of blanks leads the word
    behind it; at the end of the text it is a part of its own.
    """
    if not text:
        return []
    parts = text.replace(BLANK, " ").split(" ")
    if "" not in parts:
        return parts
    words, run = [], 0
    for part in parts:
        if part:
            words.append(" " * run + part)
            run = 0
        else:
            run += 1
    if run:
        words.append(" " * (run - 1))
    return words


class PairTable:
    """Pairs of symbols whose concatenation is a piece, by binary search.

    Symbols are the pieces, and behind them characters that stand in pieces without being one;
    any other character has a number of its own that no pair holds.
    """

    # More than there are symbols.
    STEP = 1 << 21

    def __init__(self, ids: dict[str, int], cost: dict[str, float], size: int):
        single = sorted({c for piece in ids for c in piece} - set(ids))
        symbols = {**ids, **{c: size + i for i, c in enumerate(single)}}
        self.pieces = size
        self.of_code = np.arange(0x110000, dtype=np.int32) + size + len(single)
        for symbol, number in symbols.items():
            if len(symbol) == 1:
                self.of_code[ord(symbol)] = number
        self.first_code = size + len(single)
        self.other = {symbols[c]: ord(c) for c in single}
        self.blank = symbols[BLANK]
        self.of_code[ord(" ")] = self.blank
        found = {}
        for piece, number in ids.items():
            for i in range(1, len(piece)):
                left, right = symbols.get(piece[:i]), symbols.get(piece[i:])
                if left is not None and right is not None:
                    found[left * self.STEP + right] = (cost[piece], number)
        keys = np.array(sorted(found), np.int64)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.cost = np.array([*(found[k][0] for k in keys.tolist()), NEVER])
        self.result = np.array([*(found[k][1] for k in keys.tolist()), -1], np.int32)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table; its end for pairs that are none."""
        # No symbol is -1, and neither is a pair with it.
        key = left.astype(np.int64) * self.STEP + right
        key[right < 0] = -1
        at = np.searchsorted(self.keys, key)
        at[self.keys[at] != key] = len(self.keys) - 1
        return at


def merge_many(symbols: np.ndarray, table: PairTable) -> np.ndarray:
    """Rows of symbols (-1 behind the last) merged to the end, each by its agenda.

    A row of the cost matrix is an agenda: its first minimum is the best pair furthest left.
    Merging takes one pair out of every row that still has one, and looks up two new ones.
    """
    done = np.full_like(symbols, -1)
    rows = np.arange(len(symbols))
    agenda = table.cost[table.find(symbols[:, :-1], symbols[:, 1:])] if symbols.shape[1] > 1 else np.empty((len(symbols), 0))
    while len(rows):
        width = symbols.shape[1]
        if width == 1:
            done[rows, :1] = symbols
            break
        best = agenda.argmin(1)
        open_rows = agenda[np.arange(len(rows)), best] < NEVER
        if not open_rows.all():
            done[rows[~open_rows], :width] = symbols[~open_rows]
            rows, symbols, agenda, best = rows[open_rows], symbols[open_rows], agenda[open_rows], best[open_rows]
            if not len(rows):
                break
        each = np.arange(len(rows))
        merged = table.result[table.find(symbols[each, best], symbols[each, best + 1])]
        column = np.arange(width - 1)
        # Everything behind the pair moves up by one.
        symbols = np.where(column <= best[:, None], symbols[:, :-1], symbols[:, 1:])
        symbols[each, best] = merged
        agenda = np.where(column[:-1] < best[:, None], agenda[:, :-1], agenda[:, 1:])
        for at in (best - 1, best):
            inner = np.flatnonzero((at >= 0) & (at < width - 2))
            place = at[inner]
            agenda[inner, place] = table.cost[table.find(symbols[inner, place], symbols[inner, place + 1])]
    return done


class PieceCodec:
    """Encoder over a vocabulary file; decoding is the library's ``decode(ids)``."""

    def __init__(self, model_path: str, check: bool = True):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.check = check
        size = self.library.get_piece_size()
        self.ids, self.cost, self.bytes = {}, {}, {}
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i)):
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError(f"piece {piece!r} crosses words")
                self.ids[piece] = i
                self.cost[piece] = -self.library.get_score(i)
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        if self.library.normalize("ﬁ  a") != f"{BLANK}ﬁ{BLANK}{BLANK}a":
            raise ValueError("the vocabulary normalises text")
        self.end = self.library.eos_id()
        self.table = PairTable(self.ids, self.cost, size)
        self._forget()

    def _forget(self) -> None:
        """Number of each word; where its ids lie, how many they are, how often it was used."""
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.lengths, self.uses = np.empty(0, np.int64), np.empty(0, np.int64)
        self.characters = 0

    def word(self, word: str) -> list[int]:
        """Ids of a word by an agenda of its own."""
        symbols = list(BLANK + word.replace(" ", BLANK))
        merged = (merge_short if len(symbols) <= SHORT else merge_long)(symbols, self.cost)
        out: list[int] = []
        for piece in merged:
            if piece in self.ids:
                out.append(self.ids[piece])
            else:
                out.extend(self.bytes[b] for b in piece.encode())
        return out

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words, one after the other, and how many each has."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], SHORT))
        flats, lengths = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for start in range(0, short, WORDS_AT_ONCE):
            part = order[start : min(start + WORDS_AT_ONCE, short)]
            text = "".join([words[i] for i in part.tolist()])
            symbols = np.full((len(part), int(sizes[part[-1]]) + 1), -1, np.int32)
            symbols[:, 0] = self.table.blank
            inside = np.arange(symbols.shape[1] - 1) < sizes[part][:, None]
            symbols[:, 1:][inside] = self.table.of_code[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
            merged = merge_many(symbols, self.table)
            filled = merged >= 0
            flat, counts = merged[filled], filled.sum(1)
            if (flat >= self.table.pieces).any():
                flat, counts = self.spell_out(flat, counts)
            flats.append(flat)
            lengths.append(counts)
        rest = [self.word(words[i]) for i in order[short:].tolist()]
        flats += [np.asarray(ids, np.int32) for ids in rest]
        lengths.append(np.array([len(ids) for ids in rest], np.int64))
        flat, counts = np.concatenate(flats), np.concatenate(lengths)
        # From the order of sizes back to that of the words.
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        starts = np.cumsum(counts) - counts
        return flat[ragged(starts[place], counts[place])], counts[place]

    def spell_out(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in place of characters that are no piece."""
        strange = np.flatnonzero(flat >= self.table.pieces)
        # Such characters are few and return often.
        spelled = {n: [self.bytes[b] for b in chr(self.code_of(n)).encode()] for n in set(flat[strange].tolist())}
        width = np.ones(len(flat), np.int64)
        width[strange] = [len(spelled[n]) for n in flat[strange].tolist()]
        out = np.repeat(flat, width)
        begin = np.cumsum(width) - width
        values = list(chain.from_iterable(spelled[n] for n in flat[strange].tolist()))
        out[ragged(begin[strange], width[strange])] = values
        row = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(row, weights=width, minlength=len(counts)).astype(np.int64)

    def code_of(self, symbol: int) -> int:
        """Code point of a character that is no piece."""
        found = self.table.other.get(symbol)
        return symbol - self.table.first_code if found is None else found

    def compare(self, words: list[str], flat: np.ndarray, lengths: np.ndarray) -> None:
        """Hold the ids of words against the library, which gets many words as one text: the
        ids of a text are those of its words."""
        # A run of blanks is a word only at the end of a text, and an empty text has no blank.
        bare = pc.equal(pc.utf8_trim(pa.array(words, pa.string()), " "), "").to_numpy(zero_copy_only=False)
        packed = [w for w, b in zip(words, bare.tolist()) if not b]
        groups = [" ".join(packed[i : i + PACKED]) for i in range(0, len(packed), PACKED)]
        theirs = list(chain.from_iterable(self.library.encode(groups, num_threads=1)))
        starts = np.cumsum(lengths) - lengths
        ours = flat[ragged(starts[~bare], lengths[~bare])]
        same = len(theirs) == len(ours) and bool((ours == np.array(theirs, np.int32)).all())
        # Where they differ, and for words of blanks, one by one.
        for i in np.flatnonzero(bare if same else bare | True).tolist():
            ids = flat[starts[i] : starts[i] + lengths[i]].tolist()
            if words[i] and ids != (other := self.library.encode(words[i])):
                raise ValueError(f"{words[i]!r}: {ids} differs from the library's {other}")
        if not same:
            raise ValueError("words differ from the library's in a text of several")

    def make_room(self) -> None:
        """Forget the less used half of the words once they are too many."""
        if self.characters <= REMEMBERED:
            return
        kept = np.flatnonzero(self.uses > np.median(self.uses))
        names = np.array(list(self.known), object)[kept].tolist()
        starts = np.cumsum(self.lengths) - self.lengths
        lengths, uses, flat = self.lengths[kept], self.uses[kept] // 2, self.flat[ragged(starts[kept], self.lengths[kept])]
        self._forget()
        self.known = {w: i for i, w in enumerate(names)}
        self.flat, self.lengths, self.uses = flat, lengths, uses
        self.characters = sum(map(len, names))

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered, and check them."""
        flat, lengths = self.words(words)
        if self.check:
            self.compare(words, flat, lengths)
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        self.flat, self.lengths = np.concatenate([self.flat, flat]), np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])
        self.characters += sum(map(len, words))

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with an end id, and where they begin."""
        self.make_room()
        texts = pc.fill_null(texts, "")
        # Texts with runs of blanks are split in Python, all others by Arrow.
        odd = pc.match_substring_regex(texts, f"^$|^ | $|  |{BLANK}").to_numpy(zero_copy_only=False)
        order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
        plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        others = [words_of(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        counts = np.concatenate([pc.list_value_length(plain).to_numpy(zero_copy_only=False), [len(w) for w in others]]).astype(np.int64)
        words = pa.concat_arrays([plain.flatten().cast(pa.large_string()), pa.array(chain.from_iterable(others), pa.large_string())])
        # Each different word is looked up once.
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        numbers = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        fresh = np.flatnonzero(numbers < 0)
        if len(fresh):
            numbers[fresh] = np.arange(len(self.known), len(self.known) + len(fresh))
            self.learn([names[i] for i in fresh.tolist()])
        numbers = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        lengths = self.lengths[numbers]
        ids = self.flat[ragged((np.cumsum(self.lengths) - self.lengths)[numbers], lengths)]
        # Back to the order of the texts, with an end id behind each.
        ends = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(counts))]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        sizes = np.diff(ends)[place]
        offsets = np.append(0, np.cumsum(sizes + 1))
        out = np.full(int(offsets[-1]), self.end, np.int32)
        out[ragged(offsets[:-1], sizes)] = ids[ragged(ends[:-1][place], sizes)]
        return out, offsets

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of every text, with an end id."""
        flat, offsets = self.encode_flat(pa.array(texts, pa.string()))
        return [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of stretches of a flat array, one stretch after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def slices(batch: pa.RecordBatch, column: int, characters: int = CHARACTERS_AT_ONCE):
    """Slices of a batch, each of about so many bytes of text; a longer text is alone."""
    sizes = np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)).astype(np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > characters:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def encode_decode(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``ids array<int>`` (with end id) and ``decoded string`` of every whole text.

    One pass, no shuffle: every Arrow batch is worked off in slices of bounded text, so a worker
    holds the ids of few documents, or of one that is longer. A null or empty text has the end id only and
    decodes to an empty text; repeated rows and null ids stay as they are; other columns
    are not read. The vocabulary file must be at ``model_path`` on every executor.
    """
    schema = df.select(col(id_column)).schema.add("ids", ArrayType(IntegerType())).add("decoded", "string")

    def run(batches):
        codec = PieceCodec(model_path)
        for part in (p for batch in batches for p in slices(batch, 1)):
            flat, offsets = codec.encode_flat(part.column(1))
            ids = flat.tolist()
            decoded = [codec.library.decode(ids[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(offsets.astype(np.int32), flat), pa.array(decoded, pa.string())],
                names=[id_column, "ids", "decoded"],
            )

    return df.select(col(id_column), col(text_column)).mapInArrow(run, schema)


def codec_digests(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Count and digests of the ids and of the decoded text, per row."""
    coded = encode_decode(df, model_path, id_column, text_column)
    return coded.select(
        col(id_column),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
