"""Subword encoding and decoding with a given SentencePiece model, by streaming Viterbi.

A text is read once from left to right. For each character boundary the lattice keeps the best
last piece that ends there and a pointer back to where that piece begins. A later piece can begin
at most one maximum piece length back, so only the boundaries in that window can still be used.
When the backward paths of all of them meet in one boundary, the pieces before it can no longer
change: their ids are given out and their boundaries forgotten.

Which path is best depends on the kind of model. For unigram models it is the largest sum of
scores. For merge (BPE) models it is the path whose neighbouring pieces all keep apart when merged
on their own: such a path exists once for every boundary, and it is the merge result (merges
inside a piece, or across it, come in the same order with or without the rest of the text). So the
ids equal those of the sentencepiece library for both kinds (for unigram models, where several
paths have the same sum, perhaps another of them).

A boundary that no piece crosses (a space mark after another character, in models made without
pieces across spaces) is a meeting point of all paths: the words between are encoded once and their
packed ids kept in a bounded memory of each Python worker. A text is cut into stretches at such
boundaries, so that only some of its words are listed at a time.

Texts and ids pass as Arrow arrays. Decoding takes the pieces' bytes by id, for a whole batch at once.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ship, with_fields

SPACE = "▁"
NOTHING = 0x7FFFFFFF  # the symbol before the first
PAIRS_KEPT = 300_000
WORDS_KEPT = 150_000  # in each of two generations
WORD_LONGEST = 64
STRETCH = 1 << 16  # characters of a text whose words are listed together


class Words(dict):
    """Packed ids of words, in two generations: words in use move on from the older one."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self.encode(word)
        if len(word) <= WORD_LONGEST:
            if len(self) >= WORDS_KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = packed
        return packed


class Model:
    """Pieces, scores and settings of a serialized model. Only identity normalization is known."""

    def __init__(self, serialized: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto.FromString(serialized)
        library = SentencePieceProcessor(model_proto=serialized)
        if spec.normalizer_spec.precompiled_charsmap or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalization are supported")
        kinds = {spec.trainer_spec.BPE: "merge", spec.trainer_spec.UNIGRAM: "unigram"}
        if spec.trainer_spec.model_type not in kinds:
            raise ValueError("only merge and unigram models are supported")
        self.kind = kinds[spec.trainer_spec.model_type]
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        self.unknown = library.unk_id()
        self.ids: dict[str, int] = {}
        self.scores: dict[int, float] = {}
        self.merges: dict[str, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.shown: list[bytes] = []
        for number in range(library.get_piece_size()):
            piece = library.id_to_piece(number)
            if library.is_byte(number):
                self.byte_ids[int(piece[3:5], 16)] = number
                self.shown.append(bytes([int(piece[3:5], 16)]))
            elif library.is_control(number):
                self.shown.append(b"")
            elif library.is_unknown(number):
                self.shown.append(" ⁇ ".encode())
            else:
                self.shown.append(piece.replace(SPACE, " ").encode())
                if not library.is_unused(number):
                    self.ids[piece] = number
                    self.scores[number] = self.merges[piece] = library.get_score(number)
        self.longest = max(map(len, self.ids), default=1)
        # The library gives an unknown character this much less than the least score.
        self.unknown_score = min(self.scores.values(), default=0.0) - 10.0
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.pieces = [library.id_to_piece(number) for number in range(library.get_piece_size())]
        self.pairs: dict[int, dict[int, bool]] = defaultdict(dict)
        self.n_pairs = 0
        self.words = Words(lambda word: packed_word(self, SPACE + word.replace(" ", SPACE)))
        # What ids that no piece has are shown as.
        self.shown.append(" ⁇ ".encode())

    @cached_property
    def shown_array(self) -> pa.Array:
        return pa.array(self.shown, pa.large_binary())

    @cached_property
    def matches(self):
        """A function that gives all pieces that end at each place of a text, in one pass."""
        automaton = ahocorasick.Automaton()
        for piece, number in self.ids.items():
            automaton.add_word(piece, (number, len(piece)))
        automaton.make_automaton()
        return automaton.iter

    def symbol(self, number: int) -> str:
        """The piece of an id; ids beyond the model stand for characters that it does not have."""
        return self.pieces[number] if number < len(self.pieces) else chr(number - len(self.pieces))

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text after all merges: best score first, then leftmost."""
        parts, scores = list(text), self.merges
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether two symbols stay as they are when merged on their own. ``left``: NOTHING at the start."""
        if self.n_pairs >= PAIRS_KEPT:
            self.n_pairs = 0
            for row in self.pairs.values():  # rows stay, as a lattice may hold them
                row.clear()
        self.n_pairs += 1
        parts = [self.symbol(right)] if left == NOTHING else [self.symbol(left), self.symbol(right)]
        known = self.pairs[left][right] = self.merged("".join(parts)) == parts
        return known


class Lattice:
    """The boundaries that are not settled yet: last symbol, where it begins, and score of the best path."""

    def __init__(self, model: Model):
        self.model, self.settled = model, 0
        self.back, self.last, self.best = [0], [NOTHING], [0.0]

    def settle(self) -> list[int]:
        """Ids up to the boundary in which all surviving paths meet; the boundaries before it are forgotten."""
        end, base = self.settled + len(self.back) - 1, self.settled
        point = meeting_point([b - base for b in self.back], range(end - base - self.model.longest + 1, end - base + 1))
        if not point:
            return []
        ids = self.path(base + point)
        self.back = [base + point, *self.back[point + 1 :]]
        self.last, self.best, self.settled = self.last[point:], self.best[point:], base + point
        return ids

    def path(self, end: int) -> list[int]:
        """Ids of the best path to a boundary. Characters that the model lacks become its bytes."""
        base, model, symbols = self.settled, self.model, []
        while end > base:
            symbols.append(self.last[end - base])
            end = self.back[end - base]
        symbols.reverse()
        strangers, before = len(model.pieces), self.last[0]
        if not symbols or max(symbols) < strangers:
            return symbols
        out: list[int] = []
        for symbol in symbols:
            if symbol < strangers:
                out.append(symbol)
            elif model.byte_ids:
                out += [model.byte_ids[b] for b in chr(symbol - strangers).encode("utf-8", "surrogatepass")]
            elif before < strangers or before == NOTHING:  # without byte pieces, a run of unknowns is one id
                out.append(model.unknown)
            before = symbol
        return out


def merge_stream(model: Model, text: str) -> Iterator[list[int]]:
    """Ids for a merge model: each boundary takes the only symbol that keeps apart from the one before."""
    lattice, pairs, full = Lattice(model), model.pairs, 2 * model.longest
    back, last, base, strangers, done = lattice.back, lattice.last, 0, len(model.pieces), 0
    after = [pairs[NOTHING]]  # what is known of the symbols after the last one of each boundary
    for end, (number, length) in model.matches(text):
        if end < done:
            continue
        while done < end:  # no piece ends there: the character stands alone
            back.append(done)
            last.append(strangers + ord(text[done]))
            after.append(pairs[last[-1]])
            done += 1
            if done - base > full and (run := lattice.settle()):
                yield run
                after = after[lattice.settled - base :]
                back, last, base = lattice.back, lattice.last, lattice.settled
        start = end + 1 - length
        apart = after[start - base].get(number)
        if apart or apart is None and model.apart(last[start - base], number):
            back.append(start)
            last.append(number)
            after.append(pairs[number])
            done = end + 1
            if done - base > full and (run := lattice.settle()):
                yield run
                after = after[lattice.settled - base :]
                back, last, base = lattice.back, lattice.last, lattice.settled
    for at in range(done, len(text)):
        lattice.back.append(at)
        lattice.last.append(strangers + ord(text[at]))
        if at + 1 - lattice.settled > full and (run := lattice.settle()):
            yield run
    yield lattice.path(len(text))


def merge_word(model: Model, word: str) -> tuple[int, ...] | None:
    """``merge_stream`` for a word that is no longer than the window, of pieces only: else None."""
    pairs = model.pairs
    back, last, after, done = [0], [NOTHING], [pairs[NOTHING]], 0
    for end, (number, length) in model.matches(word):
        if end > done:
            return None
        if end == done:
            start = end + 1 - length
            apart = after[start].get(number)
            if apart or apart is None and model.apart(last[start], number):
                back.append(start)
                last.append(number)
                after.append(pairs[number])
                done += 1
    if done < len(word):
        return None
    ids = []
    while done:
        ids.append(last[done])
        done = back[done]
    return tuple(ids[::-1])


def unigram_stream(model: Model, text: str) -> Iterator[list[int]]:
    """Ids for a unigram model: each boundary takes the symbol of the largest sum of scores."""
    lattice, scores, full = Lattice(model), model.scores, 2 * model.longest
    strangers, matches = len(model.pieces), model.matches(text)
    match = next(matches, None)
    for end, character in enumerate(text):
        base = lattice.settled
        at, symbol = end, strangers + ord(character)
        top = lattice.best[end - base] + model.unknown_score
        while match and match[0] == end:
            number, length = match[1]
            score = lattice.best[end + 1 - length - base] + scores[number]
            if score > top or at == end and symbol >= strangers and length == 1:
                top, at, symbol = score, end + 1 - length, number
            match = next(matches, None)
        lattice.back.append(at)
        lattice.last.append(symbol)
        lattice.best.append(top)
        if len(lattice.back) > full:
            if run := lattice.settle():
                yield run
    yield lattice.path(len(text))


def stream(model: Model, text: str) -> Iterator[list[int]]:
    """Ids of the text, in runs, each given out as soon as it is settled."""
    return merge_stream(model, text) if model.kind == "merge" else unigram_stream(model, text)


def meeting_point(back: list[int], boundaries: Iterable[int]) -> int:
    """The last boundary on the best paths of all given ones."""
    alive = set(boundaries)
    while len(alive) > 1:
        far = max(alive)
        alive.remove(far)
        alive.add(back[far])
    return alive.pop()


def packed(ids: Iterable[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def packed_word(model: Model, word: str) -> bytes:
    """Ids of a word, or of a text of a model whose pieces cross spaces."""
    if model.kind == "merge" and len(word) <= 2 * model.longest and (ids := merge_word(model, word)) is not None:
        return packed(ids)
    return b"".join([packed(run) for run in stream(model, word)])


WORD = re.compile(" +[^ ]*")


def stretches(text: str, size: int) -> Iterator[str]:
    """A text that begins with a space, cut before spaces that follow another character, about every ``size``."""
    start = 0
    while len(text) - start > size:
        cut = text.rfind(" ", start + 1, start + size)
        while cut > start and text[cut - 1] == " ":
            cut -= 1
        if cut <= start:  # a longer word, or a longer run of spaces before one
            cut = start + 1
            while (cut := text.find(" ", cut)) > 0 and text[cut - 1] == " ":
                cut += 1
            if cut < 0:
                break
        yield text[start:cut]
        start = cut
    yield text[start:]


def encoded(model: Model, text: str | None) -> bytes:
    """Packed ids of a text. Null and empty texts have none."""
    if not text:
        return b""
    if SPACE in text:
        text = text.replace(SPACE, " ")  # the mark is a space
    if not model.by_words:
        return packed_word(model, (SPACE if model.prefix else "") + text.replace(" ", SPACE))
    out = []
    if model.prefix:
        text = " " + text
    elif text[0] != " ":  # without a mark before it, the first word is like no other
        first, space, text = text.partition(" ")
        out.append(packed_word(model, first))
        if not space:
            return out[0]
        text = " " + text
    words = model.words
    for part in stretches(text, STRETCH):
        if "  " not in part and part[-1] != " ":
            out += [words[word] for word in part[1:].split(" ")]
        else:
            out += [words[word[1:]] for word in WORD.findall(part)]
    return b"".join(out)


def encode_text(model: Model, text: str | None) -> list[int]:
    """Ids of a text. Null and empty texts have none."""
    return np.frombuffer(encoded(model, text), np.int32).tolist()


def decode_ids(model: Model, ids: Iterable[int | None] | None) -> str:
    """The text of ids: exactly the encoded one, but that a literal space mark comes back as a space.

    An id that is null, negative or beyond the model is shown as an unknown piece.
    """
    return decode_array(model, pa.array([None if ids is None else list(ids)], pa.list_(pa.int32())))[0].as_py()


def decode_array(model: Model, rows: pa.ListArray) -> pa.Array:
    """The texts of lists of ids: bytes of all pieces in one array, cut where the lists end."""
    rows = pc.fill_null(rows, pa.scalar([], rows.type))
    ids, unknown = rows.flatten(), len(model.shown) - 1
    ids = pc.fill_null(ids, unknown)
    if len(ids) and (pc.min(ids).as_py() < 0 or pc.max(ids).as_py() > unknown):
        inside = pc.and_(pc.greater_equal(ids, 0), pc.less(ids, unknown))
        ids = pc.if_else(inside, ids, pa.scalar(unknown, ids.type))
    shown = model.shown_array.take(ids)
    ends = np.frombuffer(shown.buffers()[1], np.int64)[shown.offset : shown.offset + len(shown) + 1] if len(shown) else np.zeros(1, np.int64)
    lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
    places = ends[np.concatenate([[0], np.cumsum(lengths)])]
    content = shown.buffers()[2] if len(shown) else pa.py_buffer(b"")
    binary = pa.Array.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(places.tobytes()), content])
    try:
        texts = binary.cast(pa.large_string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = pa.array([b.as_py().decode("utf-8", "replace") for b in binary], pa.large_string())
    if model.prefix:
        texts = pc.if_else(pc.starts_with(texts, " "), pc.utf8_slice_codeunits(texts, 1), texts)
    return texts


_MODELS: dict[int, Model] = {}


def loaded(serialized) -> Model:
    """The model of a broadcast, read once in each Python worker."""
    model = _MODELS.get(serialized.value[0])
    if model is None:
        _MODELS.clear()
        model = _MODELS[serialized.value[0]] = Model(serialized.value[1])
    return model


def shared(df: DataFrame, model_file: str, most_bytes: int):
    """The model file, broadcast: its size is bounded, whatever the data's size."""
    import zlib

    ship(df.sparkSession)
    with open(model_file, "rb") as f:
        content = f.read(most_bytes + 1)
    if len(content) > most_bytes:
        raise ValueError(f"the model file is larger than {most_bytes} bytes")
    return df.sparkSession.sparkContext.broadcast((zlib.crc32(content), content))


MODEL_BYTES = 64 << 20


def encode_array(model: Model, texts: pa.Array) -> pa.ListArray:
    """Ids of each text."""
    rows = [encoded(model, text) for text in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, rows)]) // 4
    if ends[-1] >= 2**31:
        raise ValueError("a batch has too many ids")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def encode(df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", most_bytes: int = MODEL_BYTES) -> DataFrame:
    """Append ``ids`` (array<int>) of a text.

    Null and empty texts give an empty array. Texts are encoded whole, in one pass that keeps a
    window of the text's lattice, never all of it. Rows are neither dropped nor joined; a column
    that has the name of the output is replaced. A model file of more than ``most_bytes`` is refused.
    """
    model = shared(df, model_file, most_bytes)

    def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = loaded(model)
        for texts in batches:
            yield encode_array(own, texts)

    udf = F.arrow_udf(encode_batches, "array<int>")
    return with_fields(df, F.struct(udf(F.col(text)).alias(ids)), [ids])


def decode(df: DataFrame, model_file: str, ids: str = "ids", text: str = "text", most_bytes: int = MODEL_BYTES) -> DataFrame:
    """Append the ``text`` of ids. Null or empty ids give an empty text; see ``encode``.

    An id that is null, negative or beyond the model is shown as an unknown piece.
    """
    model = shared(df, model_file, most_bytes)

    def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = loaded(model)
        for rows in batches:
            yield decode_array(own, rows).cast(pa.string())

    udf = F.arrow_udf(decode_batches, "string")
    return with_fields(df, F.struct(udf(F.col(ids)).alias(text)), [text])


def round_trip(
    df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", same: str = "round_trip", most_bytes: int = MODEL_BYTES
) -> DataFrame:
    """Append ``ids`` and ``same``: whether decoding them gives the text back (null and empty texts: yes).

    As ``encode`` and ``decode``, but a text passes to Python once. A literal space mark comes back as a space,
    so a text with one is not the same.
    """
    model = shared(df, model_file, most_bytes)

    def both_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = loaded(model)
        for texts in batches:
            rows = encode_array(own, texts)
            equal = pc.equal(decode_array(own, rows), pc.fill_null(texts.cast(pa.large_string()), ""))
            yield pa.StructArray.from_arrays([rows, equal], names=["ids", "same"])

    udf = F.arrow_udf(both_batches, "ids array<int>, same boolean")
    fields = F.transform(F.array(udf(F.col(text))), lambda x: F.struct(x["ids"].alias(ids), x["same"].alias(same)))[0]
    return with_fields(df, fields, [ids, same])
