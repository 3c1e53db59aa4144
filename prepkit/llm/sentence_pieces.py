"""SentencePiece BPE over whole texts: encoding by vectorised merge rounds, decoding by concatenation."""

from __future__ import annotations

import codecs
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import col, map_arrow, slices

SPACE = "▁"
"""Stands for a space in pieces."""

UNKNOWN_SURFACE = " ⁇ "
"""What an unknown id decodes to."""

KNOWN_WORDS = 400_000
"""Words whose ids a worker remembers; beyond that it starts anew."""

LONG_WORD = 64
"""Longer words are encoded each time and not remembered."""

TOGETHER = 2_000_000
"""Code points of new words that go through the merge rounds at once; a longer word goes alone."""

NEVER = np.iinfo(np.int64).max
"""Rank of a pair that does not merge."""


def _one_for_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("prepkit-bytes", _one_for_each_byte)


class _Table:
    """Values by integer key, looked up for whole arrays: one slot a key, the few that clash in a sorted list."""

    BITS = 20

    def __init__(self, found: dict[int, int], missing: int):
        keys = np.array(sorted(found), np.int64)
        values = np.array([found[k] for k in keys.tolist()], np.int64)
        slots, first = np.unique(self._slot(keys), return_index=True)
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.values = np.full(1 << self.BITS, missing, np.int64)
        self.keys[slots], self.values[slots] = keys[first], values[first]
        rest = np.ones(len(keys), bool)
        rest[first] = False
        self.rest_keys, self.rest_values, self.missing = keys[rest], values[rest], missing

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        held = self.keys[slots]
        out = self.values[slots]
        out[held != keys] = self.missing
        if len(self.rest_keys):
            clash = np.flatnonzero((held != keys) & (held >= 0))
            at = np.searchsorted(self.rest_keys, keys[clash])
            at[at == len(self.rest_keys)] = 0
            hit = self.rest_keys[at] == keys[clash]
            out[clash[hit]] = self.rest_values[at[hit]]
        return out


class PieceModel:
    """A SentencePiece BPE model without normalisation, read through the library, encoding in numpy.

    Models that the merge rounds do not cover are refused: other kinds than BPE cannot be told from
    outside, but a model that normalises text, drops white space or holds unused pieces can.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if model.normalize(" A\t ﬁ  b ") != f"{SPACE}{SPACE}A\t{SPACE}ﬁ{SPACE}{SPACE}b{SPACE}":
            raise ValueError("Only models that keep text as it is and put a space before it are supported.")
        if any(model.is_unused(i) for i in ids):
            raise ValueError("Models with unused pieces are not supported.")
        self.end_id, self.unknown_id = model.eos_id(), model.unk_id()
        special = {i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.piece_id = {model.id_to_piece(i): i for i in ids if i not in special}
        self.byte_id = np.full(256, self.unknown_id, np.int64)
        for i in special:
            if model.is_byte(i):
                self.byte_id[int(model.id_to_piece(i)[3:5], 16)] = i
        if (self.byte_id == self.unknown_id).any():
            raise ValueError("Only models with a piece for every byte are supported.")
        self._read_merges({p: model.get_score(i) for p, i in self.piece_id.items()})
        self._read_surfaces(model, special)
        self.known: dict[str, bytes] = {}

    def _read_merges(self, scores: dict[str, float]) -> None:
        chars = sorted({ch for p in scores for ch in p})
        names = chars + sorted(p for p in scores if len(p) > 1)
        symbol = {name: i for i, name in enumerate(names)}
        self.size = len(names) + 1  # the last one stands for any other character
        self.symbol_of = np.full(0x110000, self.size - 1, np.int32)
        self.symbol_of[[ord(ch) for ch in chars]] = np.arange(len(chars))
        self.symbol_id = np.array([self.piece_id.get(name, -1) for name in names] + [-1], np.int64)
        place = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        ranks, made, near = {}, {}, {}
        for piece, score in scores.items():
            for i in range(1, len(piece)):
                near[ord(piece[i - 1]) << 21 | ord(piece[i])] = 1
                left, right = symbol.get(piece[:i]), symbol.get(piece[i:])
                if left is not None and right is not None:
                    key = left * self.size + right
                    ranks[key], made[key] = place[score], symbol[piece]
        self.ranks, self.made = _Table(ranks, NEVER), _Table(made, -1)
        self.near = _Table(near, 0)
        """Characters that stand next to each other in some piece; no merge crosses any other boundary."""
        self.cut = self._byte_cuts(near)

    @staticmethod
    def _byte_cuts(near: dict[int, int]) -> np.ndarray:
        """Whether a word ends between two bytes of a text, by (first << 8 | second): no piece spans such a place."""
        gap = ord(SPACE)
        lead = {k >> 21 for k in near}
        after = {k & 0x1FFFFF for k in near}
        cut = np.zeros((256, 256), bool)
        for a in range(128):
            for b in range(128):
                cut[a, b] = (gap if a == 32 else a) << 21 | (gap if b == 32 else b) not in near
        for b in range(128):  # beside a part of a longer character
            cut[128:, b] = not any(k & 0x1FFFFF == (gap if b == 32 else b) and k >> 21 > 127 and k >> 21 != gap for k in near) \
                if b == 32 else b not in after
            cut[b, 128:] = b not in lead and b != 32
        return cut.ravel()

    def _read_surfaces(self, model, special: set[int]) -> None:
        surfaces, self.control, self.leads = [], [], []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.control.append(model.is_control(i))
            self.leads.append(i not in special and piece.startswith(SPACE))
            if model.is_byte(i):
                surfaces.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                surfaces.append(b"")
            elif model.is_unknown(i):
                surfaces.append(UNKNOWN_SURFACE.encode())
            else:
                surfaces.append(piece.replace(SPACE, " ").encode())
        self.surfaces = pa.array(surfaces, pa.binary())
        self.control, self.leads = np.array(self.control), np.array(self.leads)
        self.byte = np.zeros(len(surfaces), bool)
        self.byte[self.byte_id] = True

    # Encoding

    def _merge(self, symbols: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge until no pair is left: (symbols, index of the first character of each).

        Each round finds every segment's lowest pair rank and merges its pairs of that rank from left to
        right at once. Where a merge would make a pair of that rank or a lower one, only the leftmost is
        merged, as the library then takes the new pair first. Segments without a pair leave the arrays.
        """
        at = np.arange(len(symbols))
        done_symbols, done_at = [], []

        def rank_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            return self.ranks[left * self.size + right]

        rank = np.full(len(symbols), NEVER)
        joined = np.flatnonzero(segment[1:] == segment[:-1])
        rank[joined] = rank_of(symbols[joined], symbols[joined + 1])
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            lowest = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.append(starts, len(symbols)))
            live = np.repeat(lowest != NEVER, lengths)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_at.append(at[~live])
                symbols, segment, at, rank = symbols[live], segment[live], at[live], rank[live]
                lengths, lowest = lengths[lowest != NEVER], lowest[lowest != NEVER]
                if not len(symbols):
                    break
            least = np.repeat(lowest, lengths)
            hits = np.flatnonzero(rank == least)
            # Pairs that overlap in a row: every second one, from the left.
            new_run = np.concatenate([[True], np.diff(hits) > 1])
            run_start = hits[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
            hits = hits[(hits - run_start) % 2 == 0]
            merged = self.made[symbols[hits] * self.size + symbols[hits + 1]]
            # Neighbours as the library sees them: pairs to the left are merged already, those to the right not.
            before = symbols[np.maximum(hits - 1, 0)].copy()
            follows = np.flatnonzero(np.diff(hits) == 2) + 1
            before[follows] = merged[follows - 1]
            has_left = (hits > 0) & (segment[np.maximum(hits - 1, 0)] == segment[hits])
            after = np.minimum(hits + 2, len(symbols) - 1)
            has_right = (hits + 2 < len(symbols)) & (segment[after] == segment[hits])
            first_made = np.minimum(
                np.where(has_left, rank_of(before, merged), NEVER),
                np.where(has_right, rank_of(merged, symbols[after]), NEVER))
            hit_segment = segment[hits]
            one_by_one = hit_segment[first_made <= least[hits]]
            if len(one_by_one):
                first = np.concatenate([[True], hit_segment[1:] != hit_segment[:-1]])
                keep = first | ~np.isin(hit_segment, one_by_one)
                hits, merged = hits[keep], merged[keep]
            symbols[hits] = merged
            stays = np.ones(len(symbols), bool)
            stays[hits + 1] = False
            moved = hits - np.arange(len(hits))  # where the merged symbols stand afterwards
            symbols, segment, at, rank = symbols[stays], segment[stays], at[stays], rank[stays]
            for here in (moved, moved[moved > 0] - 1):
                right = np.minimum(here + 1, len(symbols) - 1)
                pair = (here + 1 < len(symbols)) & (segment[right] == segment[here])
                rank[here] = np.where(pair, rank_of(symbols[here], symbols[right]), NEVER)
        if not done_at:
            return symbols, at
        at = np.concatenate(done_at)
        order = np.argsort(at)
        return np.concatenate(done_symbols)[order], at[order]

    def _new(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        points[points == 32] = ord(SPACE)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        symbols = self.symbol_of[points].astype(np.int64)
        cut = self.near[points[:-1] << 21 | points[1:]] == 0
        cut[ends[:-1] - 1] = True
        segment = np.concatenate([[0], np.cumsum(cut)])
        symbols, at = self._merge(symbols, segment)
        ids = self.symbol_id[symbols]
        counts = np.ones(len(ids), np.int64)
        for i in np.flatnonzero(ids < 0):
            counts[i] = len(chr(points[at[i]]).encode())
        out = np.repeat(ids, counts)
        firsts = np.cumsum(counts) - counts
        for i in np.flatnonzero(ids < 0):
            raw = np.frombuffer(chr(points[at[i]]).encode(), np.uint8)
            out[firsts[i]:firsts[i] + counts[i]] = self.byte_id[raw]
        token_ends = np.cumsum(counts)[np.searchsorted(at, ends, side="left") - 1]
        packed = out.astype("<u4").tobytes()
        edges = [0, *(4 * token_ends).tolist()]
        return [packed[a:b] for a, b in zip(edges, edges[1:])]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        known = self.known
        out = [known.get(w) for w in words]
        new = [i for i, ids in enumerate(out) if ids is None]
        if not new:
            return out
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
        ends = np.cumsum([len(words[i]) for i in new])
        start = 0
        while start < len(new):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + TOGETHER, side="right")))
            for i, ids in zip(new[start:stop], self._new([words[i] for i in new[start:stop]]), strict=True):
                out[i] = ids
                if len(words[i]) <= LONG_WORD:
                    known[words[i]] = ids
            start = stop
        return out

    def _words(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The words of all texts in a row, spaces first, and the number of words of each text."""
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[:len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[:offsets[-1]]
        flag = np.zeros(len(data), bool)
        if len(data):
            flag[1:] = self.cut[data[:-1].astype(np.uint16) << 8 | data[1:]]
        flag[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(flag)
        edges = np.append(starts, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(data))
        return words, np.diff(np.searchsorted(starts, offsets))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each); nulls count as empty texts. No end ids."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if not len(texts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        texts = pc.replace_substring(texts, SPACE, " ")
        texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        words, counts = self._words(pa.concat_arrays([texts]))
        coded = words.dictionary_encode()
        found = self._ids_of(coded.dictionary.to_pylist())
        pool = pa.array(found, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(pool.buffers()[1], np.int64)[pool.offset:pool.offset + len(pool) + 1] // 4
        ids = np.frombuffer(pool.buffers()[2] or b"", "<i4")[ends[0]:ends[-1]]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    # Decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.StringArray:
        """The texts of rows of ids. Ids outside the vocabulary raise.

        The first piece of a text loses the space that encoding put there. Bytes that make no character
        become one replacement character each.
        """
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.surfaces)):
            raise ValueError("An id lies outside the vocabulary.")
        ends = np.concatenate([[0], np.cumsum(counts)])
        texts = self.surfaces.take(pa.array(ids, pa.int32()))
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(ids) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        stays = np.ones(len(data), bool)
        real = np.flatnonzero(~self.control[ids])
        first = np.searchsorted(real, ends[:-1])
        has = first < len(real)
        first = real[first[has]]
        first = first[first < ends[1:][has]]
        stays[offsets[first[self.leads[ids[first]]]]] = False
        kept = np.concatenate([[0], np.cumsum(stays)])
        edges = kept[offsets[ends]].astype(np.int32)
        data = data[stays]
        raw = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(edges), pa.py_buffer(data)])
        odd = np.add.reduceat(np.append(self.byte[ids], False).astype(np.int64), ends[:-1])[counts > 0].any() \
            if len(counts) and len(ids) else False
        if odd:
            return self._decode_bytes(ids, ends, data, kept[offsets])
        return raw.cast(pa.string())

    def _decode_bytes(self, ids: np.ndarray, ends: np.ndarray, data: np.ndarray, edges: np.ndarray) -> pa.StringArray:
        """Texts that hold byte pieces. A control piece ends a character, even where it has no surface."""
        cuts = np.union1d(ends, np.flatnonzero(self.control[ids]))
        raw, at = data.tobytes(), edges[cuts].tolist()
        parts = [raw[a:b].decode("utf-8", "prepkit-bytes") for a, b in zip(at, at[1:])]
        first = np.searchsorted(cuts, ends).tolist()
        return pa.array(["".join(parts[a:b]) for a, b in zip(first, first[1:])], pa.string())


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One model per worker process and file."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))


def _encoded(model: PieceModel, texts: pa.Array, end: bool) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = model.encode(texts)
    if not end:
        return ids, counts
    return np.insert(ids, np.cumsum(counts), model.end_id).astype(np.int32), counts + 1


def _added(df: DataFrame, read: str, added: dict[str, str], work: Callable) -> DataFrame:
    """All columns but those named like an added one, and what `work` makes of the column `read`."""
    others = [name for name in df.columns if name.lower() not in added]
    safe = [f"c{i}" for i in range(len(others))]
    rows = df.select(*[col(n).alias(s) for n, s in zip(others, safe, strict=True)], col(read).alias("read"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            parts = slices(whole, "read") if pa.types.is_string(whole["read"].type) else [whole]
            for batch in parts:
                yield pa.RecordBatch.from_arrays([*[batch[s] for s in safe], *work(batch["read"])], [*safe, *added])

    schema = [f"{s} {df.schema[n].dataType.simpleString()}" for n, s in zip(others, safe, strict=True)]
    done = map_arrow(rows, run, ", ".join([*schema, *[f"{n} {t}" for n, t in added.items()]]))
    return done.select(*[F.col(s).alias(n) for s, n in zip(safe, others, strict=True)], *added)


def encode(df: DataFrame, model: str, text: str = "text", end: bool = True) -> DataFrame:
    """Add `ids` (array of int), as the library gives them for the whole text, with its end id if `end`.

    `model` is the path of a BPE model file that the executors can read. A null or empty text has no ids
    but the end id. Each row is on its own: ties, repeated rows and null keys need no rule, and an empty
    table stays empty. A column named `ids` is replaced. Nothing is shuffled. Distinct words of a batch are
    encoded once; a word longer than a batch goes through the merge rounds alone.
    """
    def work(texts: pa.Array) -> list[pa.Array]:
        return [_lists(*_encoded(piece_model(model), texts, end))]

    return _added(df.withColumn(text, col(text).cast("string")), text, {"ids": "array<int>"}, work)


def decode(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Add `decoded`: the text that the library's `decode(ids)` gives. Null ids give a null text.

    Null ids inside an array, and ids that the vocabulary lacks, raise. A column named `decoded` is replaced.
    """
    def work(rows: pa.Array) -> list[pa.Array]:
        counts = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = rows.flatten()
        if flat.null_count:
            raise ValueError("A null id cannot be decoded.")
        texts = piece_model(model).decode(flat.to_numpy(zero_copy_only=False), counts)
        return [pc.if_else(rows.is_valid(), texts, pa.scalar(None, pa.string()))]

    return _added(df.withColumn(ids, col(ids).cast("array<int>")), ids, {"decoded": "string"}, work)


def round_trip(df: DataFrame, model: str, text: str = "text", end: bool = True) -> DataFrame:
    """`encode` and then `decode` in one pass over the texts: adds `ids` and `decoded`."""
    def work(texts: pa.Array) -> list[pa.Array]:
        codec = piece_model(model)
        ids, counts = _encoded(codec, texts, end)
        return [_lists(ids, counts), codec.decode(ids, counts)]

    return _added(df.withColumn(text, col(text).cast("string")), text, {"ids": "array<int>", "decoded": "string"}, work)
