"""Token ids of texts by the ``tokenizers`` library, each distinct word of a batch encoded once.

The vocabulary's pre-tokeniser never joins characters across white space, so a text's ids are those of its white-space units in
a row. A batch's units are made unique in Arrow. Units that are Latin-1 letters with or without ASCII signs around them, most by
far, are lower-cased and cut in Arrow too, so that "The", "(the" and "the." share a piece; pieces are looked up in a bounded
per-process memory, an Arrow array, and only unknown ones go through the library. Other units of Latin-1 characters are cut by
the tokenizer's own pattern; the rest goes through the whole tokenizer as it is.
"""

import functools
import itertools
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer, pre_tokenizers

# Entries a process remembers before it starts afresh.
REMEMBER = 250_000
# The pattern of the tokenizer file, here applied to lower-cased Latin-1 units.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Units that this pattern cuts into signs, letters and signs. Right before letters, an apostrophe may belong to them.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
PLAIN = r"^(?:[!-/:-@\[-`{-~]*[!-&(-/:-@\[-`{-~])?[A-Za-zªµºÀ-ÖØ-öø-ÿ]+[!-/:-@\[-`{-~]*$"


def gather(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat`` in a row, given where each begins and how long it is, and where each ends in the result."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], ends


def spread(made: list[bytes], units: pa.DictionaryArray, offsets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids (uint32) of texts in a row, and where each text ends.

    ``made`` has the little-endian ids of each distinct unit, ``units`` the units of all texts, ``offsets`` where texts begin in them.
    """
    sizes = np.fromiter(map(len, made), np.int64, len(made)) // 4
    return _spread(np.frombuffer(b"".join(made), "<u4"), np.cumsum(sizes) - sizes, sizes, units, offsets)


def _spread(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray, units: pa.DictionaryArray, offsets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    index = units.indices.to_numpy()
    ids, ends = gather(flat, first[index], sizes[index])
    cut = offsets.to_numpy()
    return ids, np.r_[0, ends][cut[1:] - cut[0]]


def _is_latin(unit: str) -> bool:
    """Whether all characters are of Latin-1."""
    return max(unit) <= "\xff"


class WordEncoder:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.pieces_only = Tokenizer(self.whole.model)
        self.pieces_only.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # The names of special tokens are found in the text as it stands, before it is cut into words: such texts go whole.
        self.special = "|".join(regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values() if t.special)
        # A word's last token, and no other, carries the model's end mark.
        suffix = self.whole.model.end_of_word_suffix
        self.ends_word = np.zeros(self.whole.get_vocab_size(), bool)
        self.ends_word[[i for token, i in self.whole.get_vocab().items() if token.endswith(suffix)]] = True
        self.units: dict[str, bytes] = {}
        self._forget_pieces()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32) and where each text ends. Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids, ends = _spread(*self._encoded(words.dictionary), words, split.offsets)
        # The names hold no white space, so a text that has one has a unit that has it.
        named = pc.match_substring_regex(words.dictionary, self.special).to_numpy(zero_copy_only=False) if self.special else np.zeros(0, bool)
        if not named.any():
            return ids, ends
        parts, cut = np.split(ids, ends[:-1]), split.offsets.to_numpy()
        hits = np.flatnonzero(named[words.indices.to_numpy()]) + cut[0]
        for i in np.unique(np.searchsorted(cut, hits, side="right") - 1).tolist():
            parts[i] = np.array(self.whole.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
        return np.concatenate(parts), np.cumsum([len(p) for p in parts])

    def forget(self) -> None:
        """Give the memory back between tasks."""
        self.units.clear()
        self._forget_pieces()

    def _forget_pieces(self) -> None:
        # Piece number i, the first one empty, has the ids flat[first[i] : first[i] + sizes[i]].
        self.pieces, self.flat = pa.array([""], pa.large_string()), np.zeros(0, "<u4")
        self.first, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encoded(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct units: all in one array, and for each unit where its own begin and how many they are."""
        plain = pc.match_substring_regex(units, PLAIN)
        easy = units.filter(plain)
        before = pc.utf8_rtrim(pc.utf8_rtrim(easy, string.punctuation), LETTERS)
        behind = pc.utf8_ltrim(pc.utf8_ltrim(easy, string.punctuation), LETTERS)
        stems = pc.utf8_trim(pc.utf8_lower(easy), string.punctuation)
        ids, ends = self._cut_ids(pa.concat_arrays([before, stems, behind]), np.arange(3 * len(easy)).reshape(3, -1).T.ravel())
        others = self._units(units.filter(pc.invert(plain)).to_pylist())
        made, first, sizes = b"".join(others), np.empty(len(units), np.int64), np.empty(len(units), np.int64)
        at = plain.to_numpy(zero_copy_only=False)
        sizes[at] = np.diff(ends[2::3], prepend=0)
        first[at] = ends[2::3] - sizes[at]
        sizes[~at] = rest = np.fromiter(map(len, others), np.int64, len(others)) // 4
        first[~at] = len(ids) + np.cumsum(rest) - rest
        return np.concatenate([ids, np.frombuffer(made, "<u4")]), first, sizes

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of units that are no plain words."""
        if len(self.units) > REMEMBER:
            self.units.clear()
        known = self.units
        mixed, other = [], []
        for u in units:
            if u not in known:
                # "<|" may name a special token.
                (mixed if (u.isascii() or _is_latin(u)) and "<|" not in u else other).append(u)
        if mixed:
            parts = [PIECES.findall(u.lower()) for u in mixed]
            ids, ends = self._cut_ids(pa.array(itertools.chain.from_iterable(parts), pa.large_string()))
            cut = (4 * np.r_[0, ends][np.cumsum([0, *map(len, parts)])]).tolist()
            coded = ids.tobytes()
            known.update((u, coded[a:b]) for u, a, b in zip(mixed, cut[:-1], cut[1:], strict=True))
        for i in range(0, len(other), 1000):
            part = other[i : i + 1000]
            for u, e in zip(part, self.whole.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[u] = np.array(e.ids, "<u4").tobytes()
        return [known[u] for u in units]

    def _cut_ids(self, pieces: pa.Array, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, in a row and in ``order`` if one is given, and where each piece ends."""
        if len(self.pieces) > REMEMBER:
            self._forget_pieces()
        distinct = pieces.dictionary_encode()
        number = pc.fill_null(pc.index_in(distinct.dictionary, value_set=self.pieces), -1).to_numpy().astype(np.int64)
        unknown = np.flatnonzero(number < 0)
        number[unknown] = len(self.pieces) + np.arange(len(unknown))
        for i in range(0, len(unknown), 20_000):
            part = distinct.dictionary.take(pa.array(unknown[i : i + 20_000]))
            ids = np.array(self.pieces_only.encode_batch_fast([" ".join(part.to_pylist())], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            sizes = np.diff(ends, prepend=0)
            self.first = np.concatenate([self.first, len(self.flat) + ends - sizes])
            self.sizes, self.flat = np.concatenate([self.sizes, sizes]), np.concatenate([self.flat, ids])
            self.pieces = pa.concat_arrays([self.pieces, part])
        number = number[distinct.indices.to_numpy() if order is None else distinct.indices.to_numpy()[order]]
        return gather(self.flat, self.first[number], self.sizes[number])


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One encoder per process and file."""
    return WordEncoder(path)
