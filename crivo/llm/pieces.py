"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes through a text once. It holds the best way to each of the last
``longest`` positions, which is as far back as a piece can reach, and the steps
since the last boundary that all these ways share. As soon as they share a new
one, the ids up to it are committed and forgotten.

Models with piece probabilities (unigram) take the best sum of scores. Models
of merges (BPE) are not about sums: a way may take a step only if merging the
two pieces' text gives just these two. Exactly one way to each position is left
then, and it is what merging the whole text would give.
"""

import heapq
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crivo.llm.units import UnitEncoder, gather

BLANK = "▁"
# Verdicts on pairs of pieces that a task remembers.
MOST_PAIRS = 1_000_000
# Characters that are searched before ids are taken, and the longest word that is
# searched among others.
_BLOCK, _LONGEST_WORD = 1 << 16, 1 << 10
_NOT_REACHED = -2


class PieceModel:
    """Pieces, scores and kind of a SentencePiece model with byte fallback.

    Only models without text normalisation and with a blank before the text
    are taken; for others a text's ids would silently differ.
    """

    def __init__(self, pieces, scores, byte_ids, unknown: int, merges: bool):
        self.pieces, self.byte_ids, self.unknown, self.merges = pieces, byte_ids, unknown, merges
        special = set(byte_ids)
        self.ids = {p: i for i, p in enumerate(pieces) if p is not None and i not in special}
        self.scores = scores
        self.longest = max(map(len, self.ids))
        self.width = [len(p or "") for p in pieces]
        self.characters = {p for p in self.ids if len(p) == 1}
        pieces_found = ahocorasick.Automaton()
        for p, i in self.ids.items():
            pieces_found.add_word(p, (i, len(p)))
        pieces_found.make_automaton()
        self.found = pieces_found.iter
        self.lowest = min(scores) - 10.0
        self.pairs: dict[int, bool] = {}
        self.alone = {}

    @classmethod
    def parse(cls, data: bytes) -> "PieceModel":
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        model.ParseFromString(data)
        spec = model.normalizer_spec
        if spec.name != "identity" or not spec.add_dummy_prefix or spec.remove_extra_whitespaces:
            raise ValueError("only models that keep the text as it is, with a blank before it")
        if not model.trainer_spec.byte_fallback:
            raise ValueError("only models with byte fallback")
        normal = [p.type == p.NORMAL for p in model.pieces]
        is_byte = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == p.BYTE}
        return cls(
            [p.piece if n else None for p, n in zip(model.pieces, normal)],
            [p.score for p in model.pieces],
            [is_byte[b] for b in range(256)],
            model.trainer_spec.unk_id,
            model.trainer_spec.model_type == model.trainer_spec.BPE,
        )

    def merged(self, text: str) -> list[str]:
        """The pieces of a text by merging: best score first, then leftmost."""
        part, after, before = list(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        queue: list = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(part) and (piece := self.ids.get(part[i] + part[j])) is not None:
                heapq.heappush(queue, (-self.scores[piece], i, part[i], part[j]))

        for i in range(len(part) - 1):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if part[i] != left or j >= len(part) or part[j] != right:
                continue
            part[i], part[j], after[i] = left + right, "", after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p]

    def follows(self, left: int, right: int) -> bool:
        """Whether two pieces stay apart when their text is merged."""
        key = left << 32 | right
        if (known := self.pairs.get(key)) is None:
            a, b = self.pieces[left], self.pieces[right]
            known = self.merged(a + b) == [a, b]
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs = {}
            self.pairs[key] = known
        return known

    def stands(self, piece: int) -> bool:
        if (known := self.alone.get(piece)) is None:
            text = self.pieces[piece]
            known = self.alone[piece] = self.merged(text) == [text]
        return known

    def fallback(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()]


class Viterbi:
    """Feed text in parts of any size; ``feed`` and ``end`` give committed ids."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.tail = ""  # the last characters, as many as a piece can have
        self.at = self.boundary = self.largest = 0
        # Of each position: score of the best way to it, and the start and id of
        # its last step; id -1 is a character without a piece.
        self.score, self.start, self.last = {0: 0.0}, {0: 0}, {0: None}
        self.held: dict[int, str] = {}  # characters without a piece

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        most = 4 * self.model.longest
        for at in range(0, len(text), most):
            self._search(text[at : at + most])
            if self.at - self.boundary > most:
                out += self._commit()
        return out

    def _search(self, text: str) -> None:
        model, score, start, last = self.model, self.score, self.start, self.last
        pairs, merges, scores = model.pairs, model.merges, model.scores
        known = len(self.tail)
        tail, before = self.tail + text, self.at - known
        gaps = []
        if not model.characters.issuperset(text):
            gaps = [i for i in range(len(tail), known, -1) if tail[i - 1] not in model.characters]
        # All pieces that end at a position, position by position.
        for end, (piece, size) in model.found(tail):
            end += 1
            if end <= known:
                continue
            while gaps and gaps[-1] < end:
                self._gap(before + gaps.pop(), tail)
            at = before + end
            if (origin := at - size) not in start:
                continue
            if merges:
                if at in start:
                    continue  # one way fits, and it is found
                left = last[origin]
                if left is None or left < 0:
                    fits = model.stands(piece)
                elif (fits := pairs.get(left << 32 | piece)) is None:
                    fits, pairs = model.follows(left, piece), model.pairs
                if fits:
                    score[at], start[at], last[at] = 0.0, origin, piece
            else:
                total = score[origin] + scores[piece]
                if at not in start or total > score[at]:
                    score[at], start[at], last[at] = total, origin, piece
        while gaps:
            self._gap(before + gaps.pop(), tail)
        self.at = before + len(tail)
        self.tail = tail[-model.longest :]
        self.largest = max(self.largest, self.at - self.boundary)

    def _gap(self, at: int, tail: str) -> None:
        """A character that is no piece is a step of its own."""
        self.score[at] = self.score[at - 1] + self.model.lowest
        self.start[at], self.last[at] = at - 1, -1
        self.held[at] = tail[at - self.at + len(self.tail) - 1]

    def _path(self, at: int) -> list[int]:
        path = []
        while at > self.boundary:
            path.append(at)
            at = self.start[at]
        return path

    def _commit(self) -> list[int]:
        """Ids up to the last boundary that the ways to all positions share from
        which a piece can still go on."""
        reach = range(max(self.boundary, self.at - self.model.longest + 1), self.at + 1)
        ways = [{*self._path(p), self.boundary} for p in reach if p in self.start]
        return self._take(max(set.intersection(*ways))) if ways else []

    def _take(self, upto: int) -> list[int]:
        out: list[int] = []
        for at in reversed(self._path(upto)):
            piece = self.last[at]
            out += self.model.fallback(self.held.pop(at)) if piece < 0 else [piece]
        if upto > self.boundary:
            for table in (self.score, self.start, self.last, self.held):
                for p in [p for p in table if p < upto]:
                    del table[p]
            self.boundary = upto
        return out

    def end(self) -> list[int]:
        out: list[int] = []
        at = self.at
        while at > self.boundary:
            piece = self.last[at]
            out += reversed(self.model.fallback(self.held[at]) if piece < 0 else [piece])
            at = self.start[at]
        out.reverse()
        return out


def encode_part(model: PieceModel, part: str) -> list[int]:
    """Ids of a part that begins with a blank mark. Marks in a row all have
    pieces of one score, which pairs cannot order: those parts are merged."""
    if model.merges and BLANK * 2 in part:
        return [
            i
            for p in model.merged(part)
            for i in ([model.ids[p]] if p in model.ids else model.fallback(p))
        ]
    search = Viterbi(model)
    return search.feed(part) + search.end()


def encode_words(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, end to end, and how many each has.

    A word is a blank mark and what follows it, without another one, in a model
    of merges no piece of which goes on into a blank mark. The words are one
    text: all ways share the boundary before each mark, so the ids of a word are
    committed there. A word longer than ``_LONGEST_WORD`` has its own search, and
    so has a mark alone, with which the next word's mark could make a piece.
    """
    ids: list[int] = []
    sizes: list[int] = []
    block: list[str] = []
    held = 0
    for word in words:
        apart = len(word) == 1 or len(word) > _LONGEST_WORD
        if apart or held + len(word) > _BLOCK:
            _search_words(model, block, ids, sizes)
            block, held = [], 0
        if apart:
            found = encode_part(model, word)
            ids += found
            sizes.append(len(found))
        else:
            block.append(word)
            held += len(word)
    _search_words(model, block, ids, sizes)
    return np.array(ids, np.int32), np.array(sizes, np.int64)


def _search_words(model: PieceModel, words: list[str], ids: list[int], sizes: list[int]) -> None:
    text = "".join(words)
    # The last piece of the one way to each position.
    last = [_NOT_REACHED] * (len(text) + 1)
    if not model.characters.issuperset(text):
        for i, character in enumerate(text):
            if character not in model.characters:
                last[i + 1] = -1
    pairs = model.pairs
    for end, (piece, size) in model.found(text):
        end += 1
        if last[end] != _NOT_REACHED:
            continue  # one way fits, and it is found
        origin = end - size
        left = -1 if text[origin] == BLANK else last[origin]
        if left == -1:
            if model.stands(piece):
                last[end] = piece
        elif left >= 0:
            if (fits := pairs.get(left << 32 | piece)) is None:
                fits, pairs = model.follows(left, piece), model.pairs
            if fits:
                last[end] = piece
    width = model.width
    out: list[int] = []
    counts: list[int] = []
    at = len(text)
    for word in reversed(words):
        before, start = len(out), at - len(word)
        while at > start:
            piece = last[at]
            if piece < 0:
                out += reversed(model.fallback(text[at - 1]))
                at -= 1
            else:
                out.append(piece)
                at -= width[piece]
        counts.append(len(out) - before)
    out.reverse()
    counts.reverse()
    ids += out
    sizes += counts


def _encoder(model: PieceModel) -> UnitEncoder:
    import re

    parts = re.compile(f"{BLANK}+[^{BLANK}]*")

    def marked(unit: str) -> str:
        return unit.replace(" ", BLANK)

    def one_by_one(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [encode_part(model, marked(u)) for u in units]
        return np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found], np.int64)

    def together(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return encode_words(model, [marked(u) for u in units])

    # No piece goes on from another character into a blank, if none does in the
    # model: every way has a boundary before the blanks that follow a word.
    if any(BLANK in p.lstrip(BLANK) for p in model.ids):
        return UnitEncoder(one_by_one, lambda text: encode_part(model, BLANK + marked(text)), r"(?s).", True)
    return UnitEncoder(
        together if model.merges and BLANK in model.ids else one_by_one,
        lambda text: [i for p in parts.findall(BLANK + marked(text)) for i in encode_part(model, p)],
        f"  |^ |{BLANK}",
        True,
    )


_loaded: dict[int, tuple[PieceModel, UnitEncoder]] = {}


def _model(data: bytes) -> tuple[PieceModel, UnitEncoder]:
    key = hash(data)
    if key not in _loaded:
        _loaded.clear()
        model = PieceModel.parse(data)
        _loaded[key] = (model, _encoder(model))
    return _loaded[key]


def encode_pieces(docs: DataFrame, text: str, model: bytes, keep: list[str], ids: str = "ids") -> DataFrame:
    """The columns ``keep`` of every row and the ids of its text, in an array.

    ``model`` is the content of a model file. Empty and null texts have no ids.
    A character without a piece becomes the pieces of its bytes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(*keep, F.col(text).alias("_text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder = _model(shared.value)
        for batch in batches:
            for rows in _slices(batch):
                found, offsets = encoder.rows(rows.column(rows.num_columns - 1))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], lists], [*keep, ids])

    return docs.mapInArrow(
        encode, T.StructType([*docs.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType()))])
    )


def decode_pieces(coded: DataFrame, ids: str, model: bytes, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and the text of its ids.

    A null list is a null text. Ids outside the model and control pieces have
    no text; bytes that are not UTF-8 become U+FFFD.
    """
    shared = coded.sparkSession.sparkContext.broadcast(model)
    coded = coded.select(*keep, F.col(ids).alias("_ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, _ = _model(shared.value)
        names = [(p or "").replace(BLANK, " ").encode() for p in model.pieces]
        for b, i in enumerate(model.byte_ids):
            names[i] = bytes([b])
        size = np.array([len(n) for n in names] + [0])
        data = np.frombuffer(b"".join(names) or b"\0", np.uint8)
        starts = np.cumsum(size) - size
        for batch in batches:
            for rows in _slices(batch):
                lists = rows.column(rows.num_columns - 1)
                codes = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                codes = np.where((codes >= 0) & (codes < len(names)), codes, len(names))
                lengths = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
                ends = np.r_[0, np.cumsum(size[codes])]
                where = np.r_[0, np.cumsum(lengths)]
                found = gather(data, starts, size, codes).tobytes()
                texts = []
                for null, a, b in zip(lists.is_null().to_pylist(), ends[where[:-1]], ends[where[1:]]):
                    value = found[a:b].decode("utf-8", "replace")
                    texts.append(None if null else value.removeprefix(" "))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:-1], pa.array(texts, pa.string())], [*keep, text]
                )

    return coded.mapInArrow(
        decode, T.StructType([*coded.schema.fields[:-1], T.StructField(text, T.StringType())])
    )


def _slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
