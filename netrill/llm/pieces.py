"""SentencePiece BPE encoding by prefix tables, and decoding.

In an encoding by merges each prefix of a text ends in exactly one token, whatever
follows. `PieceModel` walks a text once: an automaton gives every piece that ends at a
place, longest first, and the first one that may stand after the last token of the
prefix before it is this prefix's last token. Ids are then read backwards. Two tokens
may stand side by side if merging their joined text by priority gives these two back.

No piece holds a blank after another character, so texts are cut before blanks; likewise
around line ends if no piece holds one, and before marks that follow a letter or digit in
no piece. Each distinct cut is encoded and decoded once per worker, as
long as the worker keeps it. Null and empty texts give the begin and end ids
only; a null doc_id stays null; repeated rows are encoded alike; an empty table gives an
empty result; further columns are not read. A long text without blanks is one cut and
takes time in proportion to its length.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrill.llm.common import table

BLANK = "▁"
#: Kinds of pieces in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Cuts longer than this are not kept in a worker's memory, and no more cuts than this.
KEEP_CHARS, KEEP_CUTS, KEEP_PAIRS = 40, 400_000, 600_000


def _cutter(texts: Collection[str]) -> re.Pattern[str]:
    """Cuts a text only between two characters that stand side by side in none of the pieces."""
    pairs = {pair for text in texts for pair in zip(text, text[1:]) if pair[0] != BLANK}
    odd = {char for text in texts for char in text if not (char.isalpha() or char.isdecimal())} - {BLANK, "\n"}
    marks = {char for char in odd if char.isascii()}
    while more := {a for a, b in pairs if b in marks and a in odd - marks}:
        marks |= more
    while wrong := {b for a, b in pairs if b in marks and a not in marks}:
        marks -= wrong
    line = "" if any("\n" in text for text in texts) else "\n"
    mark = "".join(map(re.escape, sorted(marks)))
    rest = f"[^{BLANK}{line}{mark}]"
    cuts = [f"{BLANK}*{rest}++"]
    if marks:
        cuts.append(f"{BLANK}*[{mark}]++{rest}*+")
    cuts.append(f"{BLANK}+")
    if line:
        cuts.append(f"{line}+")
    return re.compile("|".join(cuts))


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at : at + size]
        at += size


def _pieces(data: bytes) -> list[tuple[str, float, int]]:
    """(text, score, kind) in the order of ids."""
    import struct

    out = []
    for number, value in _fields(data):
        if number == 1:
            own = dict(_fields(value))
            score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
            out.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
    return out


class PieceModel:
    """Encoder and decoder of one model: BPE with byte fallback, no normalisation, leading blank."""

    def __init__(self, data: bytes):
        import ahocorasick

        listed = _pieces(data)
        self.texts = [text for text, _, _ in listed]
        self.kinds = [kind for _, _, kind in listed]
        self.scores = {}
        self.ids = {}
        self.bytes = [0] * 256
        lone: set[str] = set()
        for ident, (text, score, kind) in enumerate(listed):
            if kind == BYTE:
                self.bytes[int(text[3:-1], 16)] = ident
            elif kind in (NORMAL, USER):
                self.ids[text], self.scores[text] = ident, score
                lone.update(text)
            if kind in (USER, UNUSED) or re.search(f"[^{BLANK}]{BLANK}", text):
                raise ValueError(f"piece {ident} of kind {kind} is not supported: {text!r}")
        if not lone <= self.ids.keys():
            raise ValueError("a character of a piece is no piece itself")
        self.begin, self.end = self.texts.index("<s>"), self.texts.index("</s>")
        self.automaton = ahocorasick.Automaton()
        #: For each piece: whether it may stand after another one, as far as known.
        self.pairs: dict[int, dict[int, bool]] = {}
        for text, ident in self.ids.items():
            # A piece that merges can't build on its own never ends a prefix.
            if len(text) == 1 or self.merged(text) == [text]:
                self.pairs[ident] = {-1: True}
                self.automaton.add_word(text, (len(text), ident, self.pairs[ident]))
        self.automaton.make_automaton()
        self.n_pairs = 0
        self.cut_at = _cutter(self.ids)
        self.cuts: dict[str, tuple[bytes, str]] = {}
        #: What a piece reads as; null where a decoder has to look at its neighbours.
        self.plain = [t.replace(BLANK, " ") if k == NORMAL else None for t, k in zip(self.texts, self.kinds, strict=True)]

    def merged(self, text: str) -> list[str]:
        """Merge neighbours by priority; only used on the joined text of two pieces."""
        parts, scores = list(text), self.scores
        while True:
            best, place = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, place = score, i
            if best is None:
                return parts
            parts[place : place + 2] = [parts[place] + parts[place + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two pieces gives these two back."""
        first, second = self.texts[left], self.texts[right]
        known = self.merged(first + second) == [first, second]
        if self.n_pairs >= KEEP_PAIRS:
            for pairs in self.pairs.values():
                pairs.clear()
                pairs[-1] = True
            self.n_pairs = 0
        self.pairs[right][left] = known
        self.n_pairs += 1
        return known

    def _table(self, text: str) -> list[int]:
        """Last tokens of all prefixes, then ids from the end; -1 is a character that is no piece."""
        # The item behind the last one is read as the prefix without characters.
        last, lengths = [-1] * (len(text) + 1), [1] * len(text)
        for place, (length, ident, pairs) in self.automaton.iter(text):
            if last[place] >= 0:  # a longer piece, they come first, is this prefix's last token
                continue
            # Characters that are no piece are in no piece either, so they never merge.
            before = last[place - length]
            fits = pairs.get(before)
            if fits is None:
                fits = self.compatible(before, ident)
            if fits:
                last[place], lengths[place] = ident, length
        out, end = [], len(text)
        while end:
            ident = last[end - 1]
            if ident >= 0:
                out.append(ident)
            else:
                out.extend(self.bytes[b] for b in reversed(text[end - 1].encode()))
            end -= lengths[end - 1]
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin and end."""
        return array("I", b"".join([ids for ids, _ in self.encode_cuts(text)])).tolist() if text else []

    def encode_cuts(self, text: str) -> list[tuple[bytes, str]]:
        """Of each cut of a text: its ids, as unsigned 32-bit integers, and the text they decode to."""
        listed = self.cut_at.findall(BLANK + text.replace(" ", BLANK))
        found = list(map(self.cuts.get, listed))
        if None in found:
            for place, cut in enumerate(listed):
                if found[place] is None:
                    found[place] = self.cuts.get(cut) or self._cut(cut)
        return found

    def _cut(self, cut: str) -> tuple[bytes, str]:
        ids = self._table(cut)
        out = array("I", ids).tobytes(), self.surface(ids)
        if len(cut) <= KEEP_CHARS:
            if len(self.cuts) >= KEEP_CUTS:
                self.cuts.clear()
            self.cuts[cut] = out
        return out

    def surface(self, ids: list[int]) -> str:
        """Text of some ids in a row; broken byte sequences become U+FFFD, one for each byte."""
        read = [self.plain[ident] for ident in ids]
        if None not in read:
            return "".join(read)
        out, held = [], bytearray()

        def flush() -> None:
            rest = bytes(held)
            while rest:
                try:
                    out.append(rest.decode())
                    break
                except UnicodeDecodeError as error:
                    out.append(rest[: error.start].decode() + "�")
                    rest = rest[error.start + 1 :]
            held.clear()

        for ident in ids:
            kind = self.kinds[ident]
            if kind == BYTE:
                held.append(int(self.texts[ident][3:-1], 16))
                continue
            flush()
            if kind == UNKNOWN:
                out.append(" ⁇ ")
            elif kind != CONTROL:
                out.append(self.texts[ident].replace(BLANK, " "))
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: control ids are silent and the leading blank goes."""
        out = self.surface(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        leading = first is not None and self.kinds[first] == NORMAL and self.texts[first].startswith(BLANK)
        return out[1:] if leading else out

    def decode_cuts(self, cuts: list[tuple[bytes, str]]) -> str:
        """`decode` of cuts in a row. A cut holds whole characters, so no byte sequence spans two."""
        whole = "".join([text for _, text in cuts])
        if not cuts:
            return whole
        first = array("I", cuts[0][0][:4])[0]
        return whole[1:] if self.texts[first].startswith(BLANK) else whole


_MODELS: dict[str, PieceModel] = {}


def model_of(path: str) -> PieceModel:
    """The model of a file that is installed on every worker; one per Python worker."""
    if path not in _MODELS:
        with open(path, "rb") as file:
            _MODELS[path] = PieceModel(file.read())
    return _MODELS[path]


def _batches(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        begin_id, end_id = array("I", [model.begin]).tobytes(), array("I", [model.end]).tobytes()
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                sizes, digests, decoded, kept, texts = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    cuts = model.encode_cuts(text) if text else []
                    ids = b"".join([begin_id, *[own for own, _ in cuts], end_id])
                    back = model.decode_cuts(cuts)
                    sizes.append(len(ids) // 4)
                    digests.append(hashlib.sha256(ids).hexdigest())
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                    if with_ids:
                        kept.append(array("I", ids).tolist())
                        texts.append(back)
                columns = [
                    part.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded, pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(kept, pa.list_(pa.int64())), pa.array(texts, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and on request `ids` and `decoded` themselves."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<bigint>, decoded string"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return slim.mapInArrow(_batches(path, with_ids), schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), default_model())
