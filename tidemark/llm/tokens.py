"""Token ids by a public tokenizer file, with a memo of words."""

from __future__ import annotations

import gc
import os
import re
import string
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Name of the vocabulary file among the installed public tokenizers.
VOCABULARY = "byte_bpe_50k.json"
#: A space before white space, or at the end: there, words don't split alone.
TIED = re.compile(r" \s| \Z")
#: A newline with no other white space beside it.
NEWLINE = re.compile(r"\n(?<=\S\n)(?=\S)")
#: Marks that never join with the letters before them, and how many of them are put aside as one.
MARKS = string.punctuation.replace("'", "")
MOST_MARKS = 3
#: Words encoded in one string: the library's own copies of it are many times its size.
CHAIN_WORDS = 8192


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, as little-endian uint16 bytes (uint32 if the vocabulary
    needs it).

    A byte-level BPE never joins a word with the space before the next one, nor with a
    newline that stands alone, so a text whose spaces stand alone is the chain of its
    words' ids. Arrow splits the texts and numbers their different words; only those are
    looked up. Words not met before are encoded together, in one string, and cut where
    ids begin with a space, or are a newline. Other texts are encoded whole. Both give
    the library's own ids.
    """

    def __init__(self, path: str | None = None, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or vocabulary_path())
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.opens, self.breaks = np.zeros(size, dtype=bool), np.zeros(size, dtype=bool)
        for word, i in self.tokenizer.get_vocab().items():
            self.opens[i], self.breaks[i] = word.startswith("Ġ"), word == "Ċ"
        self.most = most
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        gc.set_threshold(200_000, 20, 50)  # the memo is many small objects without cycles

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _chain(self, words: list[str], before: str, first: np.ndarray) -> None:
        """Put words into the memo that are encoded as a chain, each behind `before`, and cut
        before the ids marked in `first`."""
        for i in range(0, len(words), CHAIN_WORDS):
            chain = words[i : i + CHAIN_WORDS]
            text = "".join([before + w for w in chain])
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            cuts = (np.flatnonzero(first[ids]) * self.dtype.itemsize).tolist()
            raw = ids.tobytes()
            self.memo.update(zip(chain, [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)], strict=True))

    def _learn(self, words: list[str]) -> None:
        """Put different words into the memo; one that begins with a newline stands behind
        that instead of a space. The memo has two generations: words of the older one move
        up when met again, and the rest of it goes when the younger one is full."""
        if len(self.memo) + len(words) > self.most:
            self.old, self.memo = self.memo, {}
        old, memo, marks, fresh, marked = self.old, self.memo, self.marks, set(), []
        for w in words:
            if (ids := old.get(w)) is not None:
                memo[w] = ids
                continue
            stem = w.rstrip(MARKS)
            if 0 < len(w) - len(stem) <= MOST_MARKS and (stem.isalpha() or stem[:1] == "\n" and stem[1:].isalpha()):
                mark = w[len(stem) :]
                marked.append((w, stem, mark))
                if mark not in marks:
                    marks[mark] = self._whole([mark])[0]
                if stem in memo:
                    continue
                if (ids := old.get(stem)) is not None:
                    memo[stem] = ids
                    continue
                w = stem
            fresh.add(w)
        self._chain([w for w in fresh if w[0] != "\n"], " ", self.opens)
        self._chain([w for w in fresh if w[0] == "\n" and "\n" not in w[1:]], "", self.breaks)
        if others := [w for w in fresh if w[0] == "\n" and "\n" in w[1:]]:
            memo.update(zip(others, self._whole(others), strict=True))
        for w, stem, mark in marked:
            memo[w] = memo[stem] + marks[mark]

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text; of many texts at once, each different word is looked up once."""
        texts = [t or "" for t in texts]
        tied = [bool(TIED.search(t)) for t in texts]
        rest = iter(self._whole([t for t, x in zip(texts, tied, strict=True) if x]))
        loose = iter(self._chained([t for t, x in zip(texts, tied, strict=True) if not x]))
        return [next(rest if x else loose) for x in tied]

    def _chained(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose spaces stand alone."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array([NEWLINE.sub(" \n", t) for t in texts], pa.large_string()), " ")
        ends, words = split.offsets.to_numpy(), split.values
        heads = self._whole(words.take(pa.array(ends[:-1])).to_pylist())
        coded = words.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # A text's first word has no space before it: it is encoded by itself, and gives nothing here.
        numbers = coded.indices.to_numpy().copy()
        numbers[ends[:-1]] = len(different)
        used = (np.bincount(numbers, minlength=len(different)) > 0).tolist()
        ids = list(map(self.memo.get, different))
        if unknown := [i for i, x in enumerate(ids) if x is None and used[i]]:
            self._learn([different[i] for i in unknown])
            for i in unknown:
                ids[i] = self.memo[different[i]]
        chain = pa.array([*ids, b""], pa.large_binary()).take(pa.array(numbers))
        _, at, raw = chain.buffers()
        cuts = np.frombuffer(at, dtype=np.int64)[chain.offset + ends].tolist()
        raw = memoryview(raw) if raw else memoryview(b"")
        return [head + raw[a:b] for head, a, b in zip(heads, cuts, cuts[1:], strict=False)]


_encoders: dict[str, Encoder] = {}


def process_encoder(path: str) -> Encoder:
    """The encoder of this worker process: its memo serves all tasks that run there."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]
