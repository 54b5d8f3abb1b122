"""SentencePiece BPE encoding and decoding by a table of each prefix's last token.

The encoding of every prefix of a text ends with one certain token, and the encoding before that token is the encoding of the
shorter prefix. So a table with one token per prefix holds the whole encoding: an automaton over the vocabulary names the
tokens that end at a position, and a token is the right one if it is compatible with the last token of the prefix before it, that
is if the two, put together, encode to just the two. The ids are read from the table backwards.

No piece of the vocabulary joins a character to a space after it, and characters without a piece become bytes; a text is cut
there into units. Each distinct unit of a batch is encoded once and remembered up to a bound.
"""

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltworks.llm.common import with_columns
from smeltworks.llm.words import spread

SPACE = "▁"
# A run of spaces with what follows it, or a line end.
UNIT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")
# Units, and token pairs, a process remembers before it starts afresh.
REMEMBER = 500_000


class PieceEncoder:
    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = [i for i in range(len(self.texts)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        crossing = [self.texts[i] for i in plain if SPACE in self.texts[i].lstrip(SPACE) or "\n" in self.texts[i]]
        if crossing:
            raise ValueError(f"pieces go on after a space or a line end: {crossing[:3]}")
        self.ids = {self.texts[i]: i for i in plain}
        self.scores = [model.get_score(i) for i in range(len(self.texts))]
        self.bytes = {int(self.texts[i][3:5], 16): i for i in range(len(self.texts)) if model.is_byte(i)}
        self.letters = {t for t in self.ids if len(t) == 1}
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            self.automaton.add_word(text, (len(text), i))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        surfaces = []
        for i, text in enumerate(self.texts):
            if model.is_byte(i):
                surfaces.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i):
                surfaces.append(b"")
            else:
                surfaces.append(" ⁇ ".encode() if model.is_unknown(i) else text.replace(SPACE, " ").encode())
        self.surfaces = pa.array(surfaces, pa.large_binary())
        self.led = np.array([t.startswith(SPACE) for t in self.texts])
        self.shown = np.array([not model.is_control(i) for i in range(len(self.texts))])

    # -- encoding

    def merged(self, text: str) -> list[int]:
        """Plain byte-pair merging, the best-scored pair first, the leftmost of equals: decides compatibility of short pairs."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -np.inf, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and self.scores[piece] > best:
                    best, at = self.scores[piece], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stand side by side; ``left`` -1: whether ``right`` stands at the beginning."""
        text = self.texts[right] if left < 0 else self.texts[left] + self.texts[right]
        return self.merged(text) == ([right] if left < 0 else [left, right])

    def _run(self, run: str) -> list[int]:
        """Ids of characters that all have a piece."""
        last, pairs = [-1] * (len(run) + 1), self.pairs
        for end, (length, token) in self.automaton.iter(run):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            left = last[start] if start else -1
            if start and left < 0:
                continue
            pair = left << 20 | token
            fits = pairs.get(pair)
            if fits is None:
                if len(pairs) > REMEMBER:
                    pairs.clear()
                fits = pairs[pair] = self._compatible(left, token)
            if fits:
                last[end] = token
        ids, end = [], len(run)
        while end:
            ids.append(last[end])
            end -= len(self.texts[last[end]])
        return ids[::-1]

    def _unit(self, unit: str) -> list[int]:
        letters = self.letters
        if letters.issuperset(unit):
            return self._run(unit)
        ids, run = [], ""
        for c in unit:
            if c in letters:
                run += c
            else:
                ids += self._run(run) if run else []
                ids += [self.bytes[b] for b in c.encode()]
                run = ""
        return ids + (self._run(run) if run else [])

    def _known(self, units: list[str]) -> list[bytes]:
        if len(self.units) > REMEMBER:
            self.units.clear()
        known = self.units
        for u in units:
            if u not in known:
                known[u] = np.array(self._unit(u), "<u4").tobytes()
        return [known[u] for u in units]

    def _led(self, words: list[str]) -> list[bytes]:
        """Ids of words, each after one space; a word may hold line ends."""
        lines = [(SPACE + w).split("\n") for w in words]
        coded = iter(self._known([u for parts in lines for u in parts if u]))
        end = np.array([self.bytes[10]], "<u4").tobytes()
        return [end.join([next(coded) if u else b"" for u in parts]) for parts in lines]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        # Words apart by single spaces are units; other texts are cut by the pattern.
        odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE))
        odd = pc.or_(odd, pc.or_(pc.ends_with(texts, " "), pc.or_(pc.starts_with(texts, " "), pc.equal(texts, ""))))
        split = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
        words = split.flatten().dictionary_encode()
        usual = _lists(*spread(self._led(words.dictionary.to_pylist()), words, split.offsets))
        rest = []
        for t in texts.filter(odd).to_pylist():
            units = UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else []
            rest.append(np.frombuffer(b"".join(self._known(units)), "<u4"))
        ends = np.cumsum([len(r) for r in rest], dtype=np.int64)
        unusual = _lists(np.concatenate([*rest, np.zeros(0, "<u4")]), ends)
        is_odd = odd.to_numpy(zero_copy_only=False)
        order = np.where(is_odd, len(usual) + np.cumsum(is_odd) - 1, np.cumsum(~is_odd) - 1)
        return pa.concat_arrays([usual, unusual]).take(pa.array(order))

    # -- decoding

    def decode(self, lists: pa.ListArray) -> list[str]:
        """Texts of lists of ids. Bytes that are no UTF-8 become one replacement character each."""
        flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        surfaces = self.surfaces.take(pa.array(flat))
        _, begins, data = surfaces.buffers()
        begins = np.frombuffer(begins, np.int64)[surfaces.offset : surfaces.offset + len(flat) + 1]
        data = memoryview(data) if data is not None else memoryview(b"")
        shown = np.r_[0, np.cumsum(self.shown[flat])]
        out = []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            first = int(np.searchsorted(shown, shown[start], "right")) - 1
            # The space put before every text is no part of it.
            skip = int(first < end and self.led[flat[first]])
            out.append(bytes(data[begins[start] + skip : begins[end]]).decode(errors="one_each"))
        return out


def _one_each(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


def _lists(flat: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(flat.astype(np.int32)))


@functools.cache
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per process and file."""
    import codecs

    codecs.register_error("one_each", _one_each)
    return PieceEncoder(path)


def round_trip(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the text's token ``ids`` and the text ``decoded`` from them.

    No begin or end ids. Null and empty texts have no ids and decode to the empty text. Input columns with the new names are
    replaced, all others stay; an empty table gives no rows.
    """

    def compute(texts: list) -> list:
        encoder = piece_encoder(model)
        ids = encoder.encode(pa.array(texts, pa.large_string()))
        return [ids, encoder.decode(ids)]

    return with_columns(docs, text, "ids array<int>, decoded string", compute, keep)


def encoded_digests(docs: DataFrame, model: str) -> DataFrame:
    done = round_trip(docs.select("doc_id", "text"), model, keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
