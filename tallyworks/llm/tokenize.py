"""Token ids of whole texts with a public byte-level BPE, for use inside tasks.

The tokenizers library does the encoding. Words repeat, so each worker keeps the ids of words it has
seen and has the library encode only new ones, many words in one call. A word can be encoded by itself
because the vocabulary's splitting rule never joins characters over a space that stands between two other
characters; texts with other white space between words go to the library as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT = "byte_bpe_50k.json"
#: Words kept per worker, in two halves: a full half becomes the old one, whose words come back when used.
#: It changes speed and memory, never ids.
CACHED_WORDS = 1_000_000
#: New words are sent to the library in texts of about so many words.
WORDS_A_CALL = 4096
#: Trailing marks that are always tokens apart from the letter or digit before them.
_MARKS = ".,;:!?#$%&*+-/=<>@^_~|()[]{}\""
_WHITE = re.compile(r"\s")

_loaded: dict[str, WordEncoder] = {}


def tokenizer_path(name: str = DEFAULT) -> str:
    """Where the vocabulary file lies on this machine; its folder is installed on each of them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str | None = None) -> WordEncoder:
    """This worker's encoder for a vocabulary file."""
    path = path or tokenizer_path()
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


class WordEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes of each id's text: byte-level vocabularies write one character per byte.
        self.width = np.zeros(self.vocabulary, np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.width[i] = len(token)
        self.words: dict[str, bytes | None] = {"\n": self._library("\n").tobytes()}
        self.old: dict[str, bytes | None] = {}

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)

    def _learn(self, new: list[str], first: bool) -> None:
        """Encode words that follow a space, or words at the start of a line (marked by a zero character)."""
        for at in range(0, len(new), WORDS_A_CALL):
            part = new[at : at + WORDS_A_CALL]
            text = "".join(part).replace("\x00", "\n") if first else " " + " ".join(part)
            ids = self._library(text)
            ends = np.cumsum(self.width[ids])
            until = np.cumsum([len(w.encode()) + (not first) for w in part])
            cuts = (np.searchsorted(ends, until, "left") + 1) * self.dtype.itemsize
            raw, last, skip = ids.tobytes(), 0, self.dtype.itemsize * first
            for word, cut in zip(part, cuts.tolist(), strict=True):
                self.words[word] = raw[last + skip : cut]
                last = cut

    def _admit(self, new: set[str]) -> None:
        """Learn words; those that can't be encoded by themselves get None."""
        words, ends = self.words, []
        stems: set[str] = set()
        # other white space is rare, so all words are looked at in one search first
        plain = not _WHITE.search("".join(new))
        for w in new:
            if not plain and _WHITE.search(w) or w in ("", "\x00"):
                words[w] = None
            elif w[-1] in _MARKS and (stem := w.rstrip(_MARKS)) and stem[-1].isalnum():
                ends.append((w, stem, "\x00" + w[len(stem) :]))
                stems.add(stem)
                stems.add(ends[-1][2])
            else:
                stems.add(w)
        stems.difference_update(words)
        first = [w for w in stems if w[0] == "\x00"]
        self._learn(first, True)
        self._learn(list(stems.difference(first)), False)
        for w, stem, marks in ends:
            words[w] = words[stem] + words[marks]

    def _lookup(self, unique: list[str]) -> list[bytes | None]:
        """Ids of different words, from the cache or else learned; the cache keeps what was used last."""
        if len(self.words) > CACHED_WORDS // 2:
            self.old, self.words = self.words, {"\n": self.words["\n"]}
        words, old = self.words, self.old
        missing = [w for w in unique if w not in words]
        if old:
            words.update((w, old[w]) for w in missing if w in old)
            missing = [w for w in missing if w not in words]
        self._admit(set(missing))
        return list(map(words.__getitem__, unique))

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text in the narrowest unsigned type; a null text has none."""
        out: list[np.ndarray] = []
        split: list[tuple[int, str]] = []
        marked: list[str] = []
        for i, text in enumerate(texts):
            out.append(np.zeros(0, self.dtype))
            if text and ("\x00" in text or any(s in text for s in self.special)):
                out[i] = self._library(text)
            elif text:
                split.append((i, text))
                marked.append("\x00" + text.replace("\n", " \n \x00"))
        if not split:
            return out
        lists = pc.split_pattern(pa.array(marked, pa.large_string()), " ")
        coded = lists.flatten().dictionary_encode()
        known = pa.array(self._lookup(coded.dictionary.to_pylist()), pa.large_binary())
        words, cut = known.take(coded.indices), lists.offsets.to_numpy()
        found = np.frombuffer(words.buffers()[2], self.dtype)
        until = np.frombuffer(words.buffers()[1], np.int64)[cut] // self.dtype.itemsize
        for k, (i, text) in enumerate(split):
            # a word is null where it has other white space
            odd = words.null_count and words[cut[k] : cut[k + 1]].null_count
            out[i] = self._library(text) if odd else found[until[k] : until[k + 1]]
        return out
