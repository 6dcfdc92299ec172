"""Byte-level BPE ids by ``tokenizers`` (.json) or ``tiktoken`` (.tiktoken), with a bounded cache of words.

The pre-tokenizer's pattern never joins a non-space to a following space, so a
text may be cut before every single space that follows a non-space; each part
then has the ids that it has in the whole text. Texts with runs of white space
around such a cut, or with a special token's string in them, are encoded whole,
and so is everything for tokenizers of another kind.
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IRREGULAR = re.compile(r"\s \s|\s \Z|  ")
_LETTERS_MARKS = re.compile(r"([^\W\d_]+)([^\w\s]*)")
MAX_CACHED, MAX_EDGES, MAX_WORD = 1_000_000, 100_000, 200
MARKS = ".,;:!?"
#: white space that ``encode_many`` does not cut at: runs but for two line feeds inside a text, and other characters
ODD = (r"  | \n|\n |\n\n\n|\n\n\z|[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}"
       r"\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]")


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_CHARACTERS = _byte_characters()


class _Words(dict):
    """Word -> ids as bytes; a missing one is encoded behind ``lead``.

    Two generations: a full one becomes the old one, and words met again come back from it.
    """

    def __init__(self, lead: str, owner: "Encoder"):
        super().__init__()
        self.lead, self.owner, self.old = lead, owner, {}

    def turn(self):
        if len(self) > self.owner.cached // 2:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        if word in self.old:
            self[word] = out = self.old[word]
            return out
        m = not word.isalpha() and _LETTERS_MARKS.fullmatch(word)
        if word.isalpha():
            out = self.owner.unit(self.lead + word)
        elif m and m[1].isalpha():  # one run of letters is one unit of the pattern, and marks after it another
            if m[2]:
                out = self[m[1]] + self.owner.marks[m[2]]
            else:
                out = self.owner.unit(self.lead + word)
        else:
            out = self.owner.whole(self.lead + word)
            if not word or word[0].isspace() or word[-1].isspace():
                self.owner.edges.add(word)
        if len(word) <= MAX_WORD:
            self[word] = out
        return out


class _Marks(dict):
    def __init__(self, owner: "Encoder"):
        super().__init__()
        self.owner = owner

    def __missing__(self, marks: str) -> bytes:
        self[marks] = out = self.owner.whole(marks)
        return out


class Encoder:
    cached = MAX_CACHED

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                     and not conf.get("normalizer"))
        self.special = [t["content"] for t in conf.get("added_tokens", [])]
        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self._reset()

    def _reset(self):
        self.edges, self.marks = set(), _Marks(self)
        self.first, self.later = _Words("", self), _Words(" ", self)

    def whole(self, text: str) -> bytes:
        return array("I", self.lib.encode(text, add_special_tokens=False).ids).tobytes()

    def unit(self, text: str) -> bytes:
        """Ids of one unit of the pre-tokenizer's pattern: letters, a space before them or none."""
        mapped = text.replace(" ", _CHARACTERS[32]) if text.isascii() else text.encode().decode("latin-1").translate(_CHARACTERS)
        return array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids; null counts as empty."""
        text = text or ""
        if not self.cuts or any(s in text for s in self.special):
            return self.whole(text)
        if len(self.edges) > MAX_EDGES:
            self._reset()
        self.later.turn()
        self.first.turn()
        head, *rest = text.split(" ")
        out = self.first[head] + b"".join(map(self.later.__getitem__, rest))
        if (head in self.edges or not self.edges.isdisjoint(rest)) and IRREGULAR.search(text):
            return self.whole(text)
        return out

    def learn(self, words: list):
        """Put words that are met for the first time into the cache, where there is a faster way than one by one."""

    def _cut(self, texts: pa.Array) -> tuple:
        """Texts without nulls; which of them are odd; the others' first words, all their words by a dictionary, and bounds of texts."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        plain = pc.if_else(odd, "", texts)
        lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        words, at = lists.flatten(), lists.offsets.to_numpy()
        odd = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        return texts, odd, words.take(pa.array(at[:-1])), words.dictionary_encode(), at

    def _apart(self, behind_space: pa.Array, behind_line: pa.Array) -> tuple:
        """Ids of many strings and where those of each begin and end; the former stand behind a space or begin with a line feed."""
        line, first, later = self.first["\n"], self.first, self.later
        words = behind_space.to_pylist()
        self.learn(words)
        found = [line + first[w[1:]] if w[:1] == "\n" else later[w] for w in words] + [first[w] for w in behind_line.to_pylist()]
        bounds = np.cumsum([0, *map(len, found)]) // 4
        return np.frombuffer(b"".join(found), "<u4"), bounds[:-1].copy(), bounds[1:]

    def _word_ids(self, heads: pa.Array, distinct: pa.Array):
        """Ids of many words, and where those of each begin and end: of ``distinct``, then of ``heads``.

        Marks at the end of a word, behind a letter or a digit, are a unit of their own: a word is encoded once with all its marks.
        """
        marked = pc.match_substring_regex(distinct, f"[A-Za-z0-9][{MARKS}]+\\z")
        stems = pc.if_else(marked, pc.ascii_rtrim(distinct, MARKS), distinct).dictionary_encode()
        marks = pc.replace_substring_regex(distinct.filter(marked), "(?s)^.*[A-Za-z0-9]", "").dictionary_encode()
        ids, begin, end = self._apart(stems.dictionary, pa.concat_arrays([marks.dictionary, heads]))
        parts = np.zeros((2, len(distinct), 2), np.int64)  # begin and end; of the stem and of its marks
        index, marked = len(stems.dictionary) + marks.indices.to_numpy(), marked.to_numpy(zero_copy_only=False)
        parts[:, :, 0] = begin[stems.indices.to_numpy()], end[stems.indices.to_numpy()]
        parts[:, marked, 1] = begin[index], end[index]
        flat, ends = _runs(ids, *parts.reshape(2, -1))
        rest = len(stems.dictionary) + len(marks.dictionary)
        return (np.concatenate((flat, ids)), np.concatenate((ends[:-1:2], len(flat) + begin[rest:])),
                np.concatenate((ends[2::2], len(flat) + end[rest:])))

    def _found(self, texts: pa.Array):
        """(texts, odd ones, ids, where those of each distinct word begin and end, words as indices of these, bounds of texts)."""
        texts, odd, heads, words, at = self._cut(texts)
        ids, begin, end = self._word_ids(heads, words.dictionary)
        index = words.indices.to_numpy().copy()
        index[at[:-1]] = len(words.dictionary) + np.arange(len(heads))
        return texts, odd, ids, begin, end, index, at

    def encode_many(self, texts: pa.Array) -> list:
        """``encode`` of each text (a string array), as bytes."""
        if not self.cuts:
            return [self.encode(t) for t in texts.to_pylist()]
        self.later.turn()
        self.first.turn()
        texts, odd, ids, begin, end, index, at = self._found(texts)
        out = []
        for lo in range(0, len(texts), 256):  # a few at a time: positions take more room than ids
            some = at[lo: lo + 257]
            words = index[some[0]: some[-1]]
            flat, bounds = _runs(ids, begin[words], end[words])
            flat, bounds = flat.tobytes(), (4 * bounds[some - some[0]]).tolist()
            out += [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in odd:
            out[i] = self.encode(texts[int(i)].as_py())
        return out

    def count_many(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text."""
        if not self.cuts:
            return np.array([len(self.encode(t)) // 4 for t in texts.to_pylist()], np.int64)
        self.later.turn()
        self.first.turn()
        texts, odd, _, begin, end, index, at = self._found(texts)
        out = np.diff(np.concatenate(([0], np.cumsum((end - begin)[index])))[at])
        for i in odd:
            out[i] = len(self.encode(texts[int(i)].as_py())) // 4
        return out


def _runs(ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple:
    """``ids[begin:end]`` of all pairs behind one another, and the bounds between them."""
    n = end - begin
    bounds = np.concatenate(([0], np.cumsum(n)))
    return ids[np.repeat(begin - bounds[:-1], n) + np.arange(bounds[-1])], bounds


class RankEncoder(Encoder):
    """The same over a file of ranks; no string of a text is a special token."""

    def __init__(self, path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.lib = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cuts, self.special = True, []
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)  # bytes of each id
        self.sizes[list(ranks.values())] = list(map(len, ranks))
        self._reset()

    def learn(self, words: list):
        """New words in one text, a space before each, where the pattern always cuts; its ids fall apart by their bytes."""
        later = self.later
        new = [w for w in words if w and w[0] != "\n" and w not in later and w not in later.old and len(w) <= MAX_WORD]
        if len(new) < 2:
            return
        text = " " + " ".join(new)
        try:
            raw = text.encode()
        except UnicodeEncodeError:
            return
        ids = np.array(self.lib.encode_ordinary(text), "<u4")
        bounds = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0x20)
        starts = np.cumsum(self.sizes[ids]) - self.sizes[ids]
        at = np.searchsorted(starts, bounds)
        if len(bounds) != len(new) or at[-1] >= len(ids) or (starts[at] != bounds).any():
            return  # one by one
        ends, blob = [*(4 * at[1:]).tolist(), 4 * len(ids)], ids.tobytes()
        later.update(zip(new, (blob[a:b] for a, b in zip((4 * at).tolist(), ends))))

    def _apart(self, behind_space: pa.Array, behind_line: pa.Array):
        """As above, with one call for all and no cache: the latter get a line feed, whose id is left out again."""
        led = pc.starts_with(behind_space, "\n")
        pieces = pa.concat_arrays([pc.if_else(led, behind_space, pc.binary_join_element_wise("", behind_space, " ")),
                                   pc.binary_join_element_wise("", behind_line, "\n")])
        bare = pc.binary_length(pieces).to_numpy() == 1  # white space alone, which would run into the next piece's
        solid = pieces.filter(pa.array(~bare))
        bounds = np.concatenate(([0], np.cumsum(pc.binary_length(solid).to_numpy().astype(np.int64))))
        ids, line, space = (np.frombuffer(self.whole(t), "<u4") for t in ("".join(solid.to_pylist()), "\n", " "))
        starts = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        at = np.searchsorted(starts, bounds)
        if len(line) != 1 or starts[-1] != bounds[-1] or (starts[at] != bounds).any():
            return super()._apart(behind_space, behind_line)
        lined = np.concatenate((led.to_numpy(zero_copy_only=False), np.ones(len(behind_line), bool)))
        begin, end = (np.where(lined, len(ids), x) for x in (len(ids) + 1, len(ids) + 1 + len(space)))
        end[lined] += 1
        begin[~bare], end[~bare] = at[:-1], at[1:]
        ids = np.concatenate((ids, line, space))
        if (ids[begin[lined]] != line[0]).any():
            return super()._apart(behind_space, behind_line)
        begin[len(led):] += 1
        return ids, begin, end

    def whole(self, text: str) -> bytes:
        return self.lib.encode_to_numpy(text, disallowed_special=()).tobytes()

    unit = whole


_encoders: dict = {}


def encoder(path: str, cached: int = MAX_CACHED) -> Encoder:
    """One per Python worker, with a cache of at most about ``cached`` words."""
    if path not in _encoders:
        _encoders[path] = (RankEncoder if path.endswith(".tiktoken") else Encoder)(path)
    _encoders[path].cached = cached
    return _encoders[path]


def slices(batch, max_rows: int = 256):
    """Small pieces of an Arrow batch, so that lists of ids stay small."""
    for at in range(0, batch.num_rows, max_rows):
        yield batch.slice(at, max_rows)


def text_slices(batch, column: str = "text", max_bytes: int = 1 << 22):
    """Pieces of an Arrow batch of about ``max_bytes`` of text, a row at least: large enough for words to recur."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    piece = (np.cumsum(sizes) - sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)
