"""Token ids of whole texts, inside tasks, with a bounded per-process cache of words."""

from __future__ import annotations

import os
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ship

ship(__name__)

CACHE_WORDS = 400_000  # entries kept for a process's lifetime; others are encoded anew where they occur
CACHE_CHARS = 24
RUN_WORDS = 1000  # words that are encoded as one text


def process_store(name: str) -> dict:
    """A dict that outlives a task: functions that are shipped by value get fresh globals each time."""
    store = sys.modules.setdefault("_process_store", types.ModuleType("_process_store"))
    return store.__dict__.setdefault(name, {})


class Encoder:
    """Byte-level BPE ids as little-endian unsigned 32-bit bytes, equal to encoding each text whole.

    The vocabulary's splitting rule starts a new word at every blank that stands between two other characters, so a text
    whose blanks all do is the concatenation of its blank-separated pieces; any other text is encoded whole. Pieces are
    told apart and put together by Arrow, so that Python sees each distinct one of a batch once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept = process_store(path)
        if not kept:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            heads = np.zeros(tokenizer.get_vocab_size(), bool)
            heads[[i for t, i in tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True  # how the vocabulary writes a blank
            special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            kept["tokenizer"], kept["ids"], kept["heads"], kept["special"] = tokenizer, {}, heads, special
        self.tokenizer, self.ids, self.heads, self.special = kept["tokenizer"], kept["ids"], kept["heads"], kept["special"]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _after_blank(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a blank before it. Many words are encoded as one text and told apart by the ids that
        start with a blank, which costs far less than a text for each."""
        out = []
        for at in range(0, len(words), RUN_WORDS):
            run = words[at:at + RUN_WORDS]
            ids, = self._encode([" " + " ".join(run)])
            starts = np.flatnonzero(self.heads[np.frombuffer(ids, "<u4")]) * 4
            if len(starts) != len(run) or starts[0] or any(s in w for s in self.special for w in run):
                out += self._encode([" " + w for w in run])
            else:
                cuts = [*starts.tolist(), len(ids)]
                out += [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def batch(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        lists = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        codes, parts = words.indices.to_numpy().astype(np.int64), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        first = codes[lists[:-1]]
        kinds, codes[lists[:-1]] = np.unique(first, return_inverse=True)
        codes[lists[:-1]] += len(parts)  # a text's first piece has no blank before it
        parts += [" " + parts[k] for k in kinds.tolist()]  # no piece holds a blank: this marks such a one
        ids = list(map(self.ids.get, parts))
        new = [k for k, v in enumerate(ids) if v is None]
        odd, plain, leading = np.zeros(len(parts), bool), [], []
        for k in new:
            p = parts[k]
            if (not p or p[0].isspace() or p[-1].isspace()) and (p[:1] != " " or p != " " and p[-1].isspace()):
                odd[k], ids[k] = True, b""
            else:
                (leading if p[:1] == " " else plain).append(k)
        for k, v in zip(plain, self._after_blank([parts[k] for k in plain])):
            ids[k] = v
        for k, v in zip(leading, self._encode([parts[k][1:] for k in leading])):
            ids[k] = v
        room = CACHE_WORDS - len(self.ids)
        if room > 0:
            self.ids.update([(parts[k], ids[k]) for k in plain + leading if len(parts[k]) <= CACHE_CHARS and "\n" not in parts[k]][:room])
        joined = pa.array(ids, pa.large_binary()).take(pa.array(codes))
        _, ends, data = joined.buffers()
        ends, data = np.frombuffer(ends, np.int64)[lists].tolist(), data if data is not None else b""
        out = [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
        if odd.any():
            for i in np.flatnonzero(np.logical_or.reduceat(odd[codes], lists[:-1])).tolist():
                out[i] = self._encode([texts[i]])[0]
        return out
