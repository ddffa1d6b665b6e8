"""Token counts by a finite-state transducer compiled from a BPE vocabulary.

Byte-pair merging is sequential, but the result is determined by its adjacent pairs: a text's
tokens are the one sequence in which every neighbouring pair survives merging when put together.
So the last token of each prefix follows from the last tokens of shorter prefixes, and only those
prefixes matter whose remaining characters can still begin a piece. That makes a finite state:

  the set of (place in the trie of pieces, last token before it, tokens since then).

A transition reads one character and emits the change in the number of tokens of the prefix. States
and transitions are compiled when first met and kept in a hash table, in which many chunks of text
are stepped through at once.

Texts are cut into chunks. A chunk's map takes the state it is entered in to the state it is left in
and the tokens it adds. At a space after a non-space the map is constant (no piece spans it), so a
chunk that begins there is entered in one known state. The map of any other chunk is compiled for the
states that may enter it: the first state, and the states in which chunks of the contents before it
are left. Chunks of the same content share one map. The maps are then composed by a parallel prefix
scan: each round joins the maps of neighbouring runs of chunks, which doubles the length of the runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefkit.llm.textblocks import code_points, text_blocks

#: Characters of a chunk.
CHUNK = 256
#: Transitions that a worker keeps; beyond them it begins anew with an empty table.
MOST_TRANSITIONS = 1 << 20
#: Bits of a state's number beside that of a chunk's content.
STATE_BITS = 36
SPACE = "▁"
#: Stands for a last token that goes with every following piece.
ANY = -1


class Vocabulary:
    """Pieces of a sentencepiece BPE model with byte fallback and no normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, trainer = model.normalizer_spec, model.trainer_spec
        normal, byte, user = 1, 6, 4
        kinds = {p.type for p in model.pieces}
        if trainer.model_type != 2 or byte not in kinds or user in kinds:
            raise ValueError("only BPE models with byte fallback and without user-defined pieces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        self.prefix = norm.add_dummy_prefix
        ranked = sorted((p for p in model.pieces if p.type in (normal, 5)), key=lambda p: -p.score)
        self.rank = {p.piece: i for i, p in enumerate(ranked)}


class Transducer:
    def __init__(self, vocabulary: Vocabulary):
        self.rank, self.prefix = vocabulary.rank, vocabulary.prefix
        pieces = [p for p in self.rank if self.merged(p) == [p]]
        self.pieces = pieces
        self.number = {p: i for i, p in enumerate(pieces)}
        self.child, self.ends, self.below = {}, [ANY], [0]
        for p in pieces:
            node = 0
            for c in p:
                self.below[node] += 1
                nxt = self.child.get((node, c))
                if nxt is None:
                    nxt = self.child[node, c] = len(self.ends)
                    self.ends.append(ANY)
                    self.below.append(0)
                node = nxt
            self.ends[node] = self.number[p]
        self.spans = any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.chars = sorted(p for p in self.rank if len(p) == 1)
        known = len(self.chars)
        self.symbols = known + 4
        self.symbol = np.full(0x110000, known + 3, np.int16 if self.symbols < 32767 else np.int32)
        self.symbol[:0x10000], self.symbol[:0x800], self.symbol[:0x80] = known + 2, known + 1, known
        for i, c in enumerate(self.chars):
            self.symbol[ord(c)] = i
        self.space = int(self.symbol[ord(SPACE)])
        self.symbol[ord(" ")] = self.space
        self.fits: dict = {}
        self.clear()

    def clear(self) -> None:
        """Forgets all states but the first (numbers given out before are no longer valid)."""
        self.states, self.state_of = [], {}
        self.bits = 16
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        self.known = 0
        self.start = self.state(((0, ANY, 0),))

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging the best pair, leftmost first, until none is left."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def goes(self, last: int, nxt: int) -> bool:
        """Whether the two pieces stay apart when merged side by side."""
        if last == ANY:
            return True
        key = last * len(self.pieces) + nxt
        if (found := self.fits.get(key)) is None:
            a, b = self.pieces[last], self.pieces[nxt]
            if not self.spans and b[0] == SPACE and a[-1] != SPACE:
                found = True
            else:
                found = self.merged(a + b) == [a, b]
            if len(self.fits) >= MOST_TRANSITIONS:
                self.fits.clear()
            self.fits[key] = found
        return found

    def state(self, items: tuple) -> int:
        found = self.state_of.get(items)
        if found is None:
            found = self.state_of[items] = len(self.states)
            self.states.append(items)
        return found

    def step(self, state: int, symbol: int) -> tuple[int, int]:
        """The next state and the tokens emitted."""
        if symbol >= len(self.chars):  # as many byte tokens as UTF-8 has bytes; merges with nothing
            return self.start, symbol - len(self.chars) + 1
        c, moved, token, delta = self.chars[symbol], [], ANY, 0
        for node, last, since in self.states[state]:  # the longest first
            nxt = self.child.get((node, c))
            if nxt is None:
                continue
            if not self.spans and c == SPACE and node == 0 and last != ANY and self.pieces[last][-1] != SPACE:
                last = ANY
            if token == ANY and self.ends[nxt] != ANY and self.goes(last, self.ends[nxt]):
                token, delta = self.ends[nxt], 1 - since
            if self.below[nxt]:
                moved.append((nxt, last, since))
        items = tuple((node, last, since + delta) for node, last, since in moved)
        return self.state((*items, (0, token, 0))), delta

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _store(self, keys: np.ndarray, values: np.ndarray) -> None:
        if (self.known + len(keys)) * 3 > len(self.keys):
            held = self.keys >= 0
            old, old_values = self.keys[held], self.values[held]
            while (self.known + len(keys)) * 3 > 1 << self.bits:
                self.bits += 1
            self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
            self.known = 0
            self._store(old, old_values)
        mask = len(self.keys) - 1
        for k, at, v in zip(keys.tolist(), self._slots(keys).tolist(), values.tolist(), strict=True):
            while self.keys[at] >= 0:
                at = (at + 1) & mask
            self.keys[at], self.values[at] = k, v
        self.known += len(keys)

    def moves(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and emitted tokens of many (state, symbol) at once; compiles new ones."""
        keys = states * self.symbols + symbols
        at = self._slots(keys)
        held = self.keys[at]
        found = self.values[at]
        off = np.flatnonzero(held != keys)
        mask = len(self.keys) - 1
        while len(off):
            free = held[off] < 0
            if free.any():
                miss = off[free]
                new = np.unique(keys[miss])
                made = [self.step(*divmod(k, self.symbols)) for k in new.tolist()]
                values = np.array([(s << 16) + d + 32768 for s, d in made], np.int64)
                self._store(new, values)
                found[miss] = values[np.searchsorted(new, keys[miss])]
                off = off[~free]
                mask = len(self.keys) - 1
                at[off] = self._slots(keys[off])  # the table may have grown
            else:
                at[off] = (at[off] + 1) & mask
            held[off] = self.keys[at[off]]
            hit = held[off] == keys[off]
            found[off[hit]] = self.values[at[off[hit]]]
            off = off[~hit]
        return found >> 16, (found & 65535) - 32768

    def run(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, entry: np.ndarray):
        """Exit states and emitted tokens of the chunks [start, end) entered in ``entry``."""
        order = np.argsort(starts - ends, kind="stable")
        at, lengths = starts[order], (ends - starts)[order]
        state, count = entry[order].copy(), np.zeros(len(order), np.int64)
        active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right")
        for i, n in enumerate(active.tolist()):
            nxt, emitted = self.moves(state[:n], symbols[at[:n] + i].astype(np.int64))
            state[:n] = nxt
            count[:n] += emitted
        exits, counts = np.empty_like(state), np.empty_like(count)
        exits[order], counts[order] = state, count
        return exits, counts

    def maps(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray, fixed: np.ndarray):
        """The maps of all contents: sorted keys (content << STATE_BITS | entry state), exit states, tokens.

        Each pass runs what the last one found to be missing, all contents at once. A content that is left
        in the same state whatever it was entered in (nearly any text) is done after two passes.
        """
        sample = np.zeros(int(kinds.max()) + 1, np.int64)
        sample[kinds] = np.arange(len(kinds))
        follows = np.unique(np.stack([kinds[:-1], kinds[1:]], axis=1)[~fixed[1:]], axis=0)
        keys, exits, tokens = (np.zeros(0, np.int64) for _ in range(3))
        new = (np.arange(len(sample)) << STATE_BITS) | self.start
        while len(new):
            content, entry = new >> STATE_BITS, new & ((1 << STATE_BITS) - 1)
            left, emitted = self.run(symbols, starts[sample[content]], ends[sample[content]], entry)
            keys = np.concatenate([keys, new])
            order = np.argsort(keys, kind="stable")
            keys, exits, tokens = keys[order], np.append(exits, left)[order], np.append(tokens, emitted)[order]
            # Each exit state enters every content that follows.
            low = np.searchsorted(follows[:, 0], content)
            n = np.searchsorted(follows[:, 0], content, "right") - low
            at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            new = np.setdiff1d((follows[at, 1] << STATE_BITS) | np.repeat(left, n), keys)
        return keys, exits, tokens

    def composed(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        """Per chunk that is ``fixed`` (entered in the first state) the tokens up to the next such chunk; 0
        for the others."""
        if not len(starts):
            return np.zeros(0, np.int64)
        contents: dict[bytes, int] = {}
        kinds = np.arange(len(starts))
        free = np.flatnonzero(~fixed)
        first = int(fixed.sum())
        kinds[fixed] = np.arange(first)
        for i in free.tolist():
            kinds[i] = first + contents.setdefault(symbols[starts[i] : ends[i]].tobytes(), len(contents))
        keys, exits, tokens = self.maps(symbols, starts, ends, kinds, fixed)
        # A node is a chunk with one of its entry states; it leads to a node of the next chunk.
        low = np.searchsorted(keys, kinds << STATE_BITS)
        n = np.searchsorted(keys, (kinds + 1) << STATE_BITS) - low
        offset = np.cumsum(n) - n
        chunk = np.repeat(np.arange(len(starts)), n)
        entry = np.arange(len(chunk)) - offset[chunk] + low[chunk]
        count = np.append(tokens[entry], 0)
        end = len(chunk)
        goes = np.full(end + 1, end)
        on = np.flatnonzero(~np.append(fixed[1:], True)[chunk])
        nxt = chunk[on] + 1
        goes[on] = offset[nxt] + np.searchsorted(keys, (kinds[nxt] << STATE_BITS) | exits[entry[on]]) - low[nxt]
        while (goes < end).any():
            count += count[goes]
            goes = goes[goes]
        return np.where(fixed, count[offset], 0)

    def counts(self, texts: list[str], chunk: int = CHUNK) -> np.ndarray:
        """Tokens of each text."""
        if self.known > MOST_TRANSITIONS:
            self.clear()
        lead = SPACE if self.prefix else ""
        texts = [lead + t if t else "" for t in texts]
        symbols = self.symbol[code_points("".join(texts))]
        lengths = np.array([len(t) for t in texts], np.int64)
        begins = np.concatenate([[0], np.cumsum(lengths)])
        # Cuts: every text's start, and about every ``chunk`` characters, at a space if one is near.
        space = symbols == self.space
        sync = np.flatnonzero(space[1:] & ~space[:-1]) + 1 if not self.spans else np.zeros(0, np.int64)
        steps = np.maximum(-(-lengths // chunk) - 1, 0)
        owner = np.repeat(np.arange(len(texts)), steps)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(steps) - steps, steps) + 1
        grid = begins[owner] + nth * chunk
        near = np.append(sync, len(symbols) + 2 * chunk)[np.searchsorted(sync, grid)]
        exact = near - grid < chunk
        cuts = np.where(exact, near, grid)
        inside = cuts < begins[owner + 1]
        cuts, exact = cuts[inside], exact[inside]
        starts = np.concatenate([begins[:-1][lengths > 0], cuts])
        fixed = np.concatenate([np.ones(int((lengths > 0).sum()), bool), exact])
        starts, first = np.unique(starts, return_index=True)
        fixed = fixed[first]
        ends = np.append(starts[1:], len(symbols))[: len(starts)]
        tokens = self.composed(symbols, starts, ends, fixed)
        sums = np.concatenate([[0], np.cumsum(tokens)])
        return sums[np.searchsorted(starts, begins[1:])] - sums[np.searchsorted(starts, begins[:-1])]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One transducer per worker process and model."""
    return Transducer(Vocabulary(path))


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``model_path`` must exist on every executor. A null or empty text has 0 bytes and 0 tokens;
    repeated rows give repeated rows, an empty table none. Only the id and text columns are read.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = transducer(model_path)
        for batch in batches:
            texts = batch.column("text")
            counts = [engine.counts(t) for _, t in text_blocks(texts)]
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
            counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), sizes, pa.array(counts)], schema=out)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
