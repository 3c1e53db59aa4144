"""Token ids of whole texts. Words are looked up, new ones are encoded by the tokenizers library in bulk."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space that byte-level BPE's pattern knows.
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPACES_RE2 = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

PIECE = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
"""White space with the run after it. The pattern never joins a character to white space that follows it."""

WHITE = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACES}]", c))
"""The characters of SPACES one by one; U+3000 is the last."""

KNOWN_WORDS = 400_000
"""Words whose ids a worker remembers, in two halves: once the newer one is full, the words not used since are dropped."""

LONG_WORD = 64
"""Longer words are encoded each time and not remembered."""

TOGETHER = 400
"""New words in one call of the library."""

LETTERS_TOGETHER = 64
"""New words of plain letters in one call."""

MARKS = r'!"#$%&()*+,-./:;<=>?@[\]^_`{|}~'
"""ASCII characters that are neither letters, digits nor white space, without the apostrophe of contractions."""

SPACE_NAME = "\u0120"
"""What byte-level names have for a space."""

# Letters and digits of any Unicode version, at the end of a string.
LETTER_END = (r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{391}-\x{3a1}\x{3a3}-\x{3ce}\x{400}-\x{481}"
              r"\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]$")


class TextEncoder:
    """Encodes like `Tokenizer.encode(text, add_special_tokens=False)` with byte-level BPE and no normalizer.

    Token boundaries never cross the start of white space, so a text's ids are its pieces' ids in a row.
    With the library's own pattern they cross neither a line break before a word nor the marks after its last letter,
    so a word's ids are looked up once for all the marks that it is met with.
    Byte-level tokens keep every byte, which tells where a piece's ids end when many new pieces are encoded
    in one call. Texts that hold the string of an added token go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        rule = self.tokenizer.pre_tokenizer
        self.cuts_marks = isinstance(rule, pre_tokenizers.ByteLevel) and rule.use_regex and not rule.add_prefix_space
        # A word of ASCII letters is one match of the pattern; its name in the vocabulary is the word, SPACE_NAME for a space.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.token_bytes = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), np.int64)
        for name, i in names.items():
            self.token_bytes[i] = len(name)  # a character of the name stands for a byte
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _new(self, words: list[str]) -> list[bytes]:
        """Words of ASCII letters go to the library by their names; other words that begin with white space and end without
        as one text, the rest as words."""
        kinds = [2 if self.cuts_marks and w.isascii() and w[w[0] == " ":].isalpha() else w[0] in WHITE and w[-1] not in WHITE
                 for w in words]
        out: list[bytes] = [b""] * len(words)
        for kind, together in ((2, LETTERS_TOGETHER), (True, TOGETHER), (False, TOGETHER)):
            at = [i for i, k in enumerate(kinds) if k == kind]
            for start in range(0, len(at), together):
                places = at[start:start + together]
                some = [words[i] for i in places]
                if kind == 2:
                    found = self.letters.encode_batch_fast(
                        [" ".join([w.replace(" ", SPACE_NAME) for w in some])], add_special_tokens=False)
                    sizes = list(map(len, some))
                else:
                    found = self.tokenizer.encode_batch_fast(
                        ["".join(some)] if kind else [some], is_pretokenized=not kind, add_special_tokens=False)
                    sizes = [len(w.encode()) for w in some]
                ids = np.array(found[0].ids, "<u4")
                ends = np.cumsum(self.token_bytes[ids])
                cuts = (4 * np.searchsorted(ends, np.cumsum(sizes), side="left") + 4).tolist()
                raw = ids.tobytes()
                for i, a, b in zip(places, [0, *cuts], cuts, strict=False):
                    out[i] = raw[a:b]
        return out

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each of some distinct words."""
        out = list(map(self.known.get, words))
        missed = [w for w, ids in zip(words, out, strict=True) if ids is None]
        if missed:
            found = list(map(self.older.get, missed))
            if len(self.known) + len(missed) > KNOWN_WORDS // 2:
                self.known, self.older = {"": b""}, self.known
            fresh = iter(self._new([w for w, ids in zip(missed, found, strict=True) if ids is None]))
            found = [next(fresh) if ids is None else ids for ids in found]
            more = iter(found)
            out = [next(more) if ids is None else ids for ids in out]
            pairs = zip(missed, found, strict=True)
            self.known.update(pairs if max(map(len, missed)) <= LONG_WORD else (p for p in pairs if len(p[0]) <= LONG_WORD))
        return out

    def _words(self, words: pa.Array) -> pa.Array:
        """Little-endian 32-bit ids of each of some distinct words, put together from those of their parts."""
        if not self.cuts_marks or not len(words):
            return pa.array(self._ids_of(words.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        words = words.cast(pa.large_string())
        bare = pc.ascii_rtrim(words, MARKS)
        ends_well = pc.match_substring_regex(bare, LETTER_END).to_numpy(zero_copy_only=False)
        breaks = pc.match_substring_regex(words, f"^\n[^{SPACES_RE2}]").to_numpy(zero_copy_only=False)
        _, offsets, data = words.buffers()
        n = len(words)
        offsets = np.frombuffer(offsets, np.int64)[words.offset:words.offset + n + 1]
        cuts = np.empty(3 * n + 1, np.int64)  # a word's line break, its body and its marks
        cuts[::3] = offsets
        cuts[1::3] = offsets[:-1] + breaks
        cuts[2::3] = np.where(ends_well, offsets[:-1] + pc.binary_length(bare).to_numpy(zero_copy_only=False), offsets[1:])
        parts = pa.LargeStringArray.from_buffers(3 * n, pa.py_buffer(cuts), data).dictionary_encode()
        ids = pa.array(self._ids_of(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        _, offsets, data = ids.take(parts.indices).buffers()
        whole = np.ascontiguousarray(np.frombuffer(offsets, np.int64)[:3 * n + 1:3])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(whole), data])

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces in a row and the number of pieces of each text."""
        plain = pc.invert(pc.match_substring_regex(texts, f"[{SPACES_RE2}][{SPACES_RE2}]|^$|^ | $|^\n"))
        # Between plain words there is one white space character; a line break joins the word after it.
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        if pc.all(plain).as_py() or len(texts) == 0:
            counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
            words = split.flatten()
            return self._with_spaces(words, counts), counts
        parts, counts = [], np.zeros(len(texts), np.int64)
        flags = plain.to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(flags.astype(np.int8))) + 1
        for rows in np.split(np.arange(len(texts)), edges):
            a, n = int(rows[0]), len(rows)
            if flags[a]:
                some = split.slice(a, n)
                counts[a:a + n] = pc.list_value_length(some).to_numpy(zero_copy_only=False)
                parts.append(self._with_spaces(some.flatten(), counts[a:a + n]).dictionary_decode())
            else:
                for i in range(a, a + n):
                    found = PIECE.findall(texts[i].as_py())
                    counts[i] = len(found)
                    parts.append(pa.array(found, pa.string()))
        return pa.concat_arrays(parts), counts

    @staticmethod
    def _with_spaces(words: pa.Array, counts: np.ndarray) -> pa.Array:
        """Put back the space before every word but a text's first and those after a line break."""
        first = np.zeros(len(words), bool)
        first[np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]] = True
        bare = pc.or_(pa.array(first), pc.starts_with(words, "\n"))
        coded = words.dictionary_encode()
        n = len(coded.dictionary)
        both = pa.concat_arrays([coded.dictionary, pc.binary_join_element_wise("", coded.dictionary, " ")])
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + n * ~bare.to_numpy(zero_copy_only=False)
        used = np.flatnonzero(np.bincount(at, minlength=2 * n))
        place = np.zeros(2 * n, np.int32)
        place[used] = np.arange(len(used))
        return pa.DictionaryArray.from_arrays(pa.array(place[at]), both.take(pa.array(used)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); nulls count as empty texts."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        holds = np.zeros(len(texts), bool)
        for token in self.added:
            holds |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not holds.any():
            return self._encode_plain(texts)
        ids, counts = self._encode_plain(pc.if_else(pa.array(holds), "", texts))
        whole = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
                 for t in texts.filter(pa.array(holds)).to_pylist()]
        at = np.cumsum(counts)[holds]  # as empty texts they have no ids yet
        counts[holds] = lengths = [len(w) for w in whole]
        return np.insert(ids, np.repeat(at, lengths), np.concatenate(whole)), counts

    def _encode_plain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, counts = self._pieces(texts)
        if not isinstance(pieces, pa.DictionaryArray):
            pieces = pieces.dictionary_encode()
        taken = self._words(pieces.dictionary).take(pieces.indices)
        _, offsets, data = taken.buffers()
        ends = np.frombuffer(offsets, np.int64)[:len(taken) + 1] // 4 if len(taken) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, "<u4")[:ends[-1]] if ends[-1] else np.empty(0, np.uint32)
        text_ends = ends[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(text_ends)


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
