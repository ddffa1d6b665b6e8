"""Token ids of whole texts by a byte-level BPE tokenizer file, with a cache of text chunks.

The tokenizer splits a text before it merges. Two kinds of place are always split: before a single
space between two characters that are not white space, and after a Latin letter that a character
other than a letter follows. So a text's ids are those of its chunks between such places, and a
chunk that occurs again need not be tokenized again.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np

from prefkit.llm.textblocks import code_points, mixed, span_hashes

#: Chunks a worker remembers; beyond them it begins anew.
MOST_CHUNKS = 1 << 19
_KIND = np.zeros(0x110000, np.uint8)  # 1: white space, 2: a letter, 4: surely no letter
for _c in range(0x250):
    _KIND[_c] = 1 if chr(_c).isspace() else 2 if chr(_c).isalpha() else 0
_KIND[[0x1680, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]] = 1
_KIND[[*range(0x21, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] |= 4


#: Fixed value: the pattern by which byte-level tokenizers split a text before they merge.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level BPE file as bytes -> id, if its ids are in the order of the
    merges and nothing else shapes the text; else None."""
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    shaped = spec["normalizer"] or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
    if model["type"] != "BPE" or shaped or model.get("end_of_word_suffix") or any(pre.get(k) != v for k, v in plain.items()):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    to_byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab[w] for w in merges]
    if ids != sorted(ids) or len(vocab) != 256 + len(merges):
        return None
    return {bytes(to_byte[c] for c in w): i for w, i in vocab.items()}


class ChunkIds:
    """Ids of texts; remembers the ids of chunks by a 64-bit hash of their characters.

    New chunks go through the tokenizers library, or, where the file is a plain byte-level BPE, through
    a merge table read from the same file (the same ids, at a fifth of the time).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        self.splits = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not spec["normalizer"]
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        self.merge = None
        if ranks := byte_ranks(spec):
            import tiktoken

            merge = tiktoken.Encoding("own", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
            self.merge = merge.encode_ordinary
        self.clear()

    @cached_property
    def tokenizer(self):
        """Loaded when a text needs it: beside a merge table only special strings do, and it is large."""
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(self.path)
        made.no_truncation()
        made.no_padding()
        return made

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.merge is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        search = self.special.search if self.special else lambda t: None
        return [self.tokenizer.encode(t, add_special_tokens=False).ids if search(t) else self.merge(t) for t in texts]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another (uint32), and the n + 1 offsets of the texts."""
        text = "".join(texts)
        points = code_points(text)
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        cut = np.zeros(len(points) + 1, bool)
        if self.splits and len(points):
            kind = _KIND[np.minimum(points, 0x10FFFF)]
            white = kind & 1
            single = (points[1:-1] == 0x20) & (white[:-2] == 0) & (white[2:] == 0)
            cut[1 : len(points) - 1] = single
            cut[1:-1] |= (kind[:-1] == 2) & ((kind[1:] & 5) > 0)
        if self.special:  # special strings are found before a text is split
            for found in self.special.finditer(text):
                cut[found.start() + 1 : found.end()] = False
        cut[edges] = True
        bounds = np.flatnonzero(cut)
        starts, ends = bounds[:-1], bounds[1:]
        h = span_hashes(mixed(points.astype(np.uint64)), starts, ends)
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.hashes) > MOST_CHUNKS:
            self.clear()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            made = self.encode([text[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            length = np.array([len(x) for x in made], np.int64)
            begin = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, np.array([i for x in made for i in x], np.uint32)])
            hashes = np.concatenate([self.hashes, distinct[new]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.length = np.concatenate([self.length, length])[order]
            at = np.searchsorted(self.hashes, distinct)
        length = self.length[at][back]
        ends_out = np.cumsum(length)
        total = int(ends_out[-1]) if len(ends_out) else 0
        take = np.arange(total) - np.repeat(ends_out - length - self.begin[at][back], length)
        offsets = np.concatenate([[0], ends_out])[np.searchsorted(bounds, edges)]
        return self.ids[take], offsets


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    """One per worker process and tokenizer file."""
    return ChunkIds(path)
