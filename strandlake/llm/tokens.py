"""Tokenisation with a public vocabulary, shared by packing and binary output.

The vocabulary's rules drop white space and never look across it, so the ids
of a text are the ids of its words in a row. Arrow kernels split a batch at
ASCII white space and number its distinct words; only words not seen before go
to the tokenizers library, and numpy lays the ids of all words out by number.
What a worker remembers is bounded; it is emptied when full.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REMEMBERED = 500_000
BATCH_BYTES = 8 << 20

#: Latin letters, then marks: the vocabulary's rule puts letters in lower case
#: and splits such a word between letters and marks, nowhere else.
_PLAIN = r"^(?P<stem>[A-Za-z\x{00c0}-\x{00d6}\x{00d8}-\x{00f6}\x{00f8}-\x{00ff}]+)(?P<marks>[!-&(-/:-@\[-`{-~]*)$"


def default_vocabulary() -> str:
    """Where the public word-level BPE vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 16-bit bytes.

    Words of Latin letters with marks behind are taken apart where the
    vocabulary's own splitting rule would do it anyway and lowered; the
    library encodes their letters without its normalising and splitting steps.
    Marks and all other words take the full path as they are.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.full = Tokenizer.from_file(vocabulary)
        if self.full.get_vocab_size() > 65_536:
            raise ValueError("this encoder keeps ids in 16 bits")
        self.plain = Tokenizer.from_file(vocabulary)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        ends = [t for t in self.full.get_vocab().items() if t[0].endswith("</w>")]
        self.last = np.zeros(65_536, bool)
        self.last[[i for _, i in ends]] = True
        self.known: dict[str, dict[str, bytes]] = {"plain": {}, "full": {}}

    def _learn(self, kind: str, words: list[str]) -> None:
        if kind == "plain":  # one word, one piece: its last id is marked as such
            ids = np.array(self.plain.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u2")
            cuts = np.concatenate([[0], np.flatnonzero(self.last[ids]) + 1]) * 2
        else:
            encoded = self.full.encode(words, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(encoded.ids, "<u2")
            cuts = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(words) + 1)) * 2
        if len(cuts) != len(words) + 1:
            raise ValueError("the vocabulary does not mark the ends of words")
        raw, cuts = ids.tobytes(), cuts.tolist()
        self.known[kind].update(zip(words, (raw[a:b] for a, b in zip(cuts, cuts[1:]))))

    def _find(self, kind: str, words: list[str]) -> list[bytes]:
        """Ids of distinct words, by one of the two paths."""
        known = self.known[kind]
        if len(known) > REMEMBERED:
            known.clear()
        found = list(map(known.get, words))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            self._learn(kind, [words[i] for i in missing])
            for i in missing:
                found[i] = known[words[i]]
        return found

    def _encode_batch(self, texts: pa.StringArray) -> list[bytes]:
        words = pc.ascii_split_whitespace(texts)
        counts = pc.list_value_length(words).to_numpy()
        coded = words.flatten().dictionary_encode()
        code, unique = coded.indices.to_numpy(), coded.dictionary
        parts = pc.extract_regex(unique, _PLAIN)
        plain = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        stems = pc.utf8_lower(parts.field("stem").filter(pa.array(plain))).dictionary_encode()
        marks = parts.field("marks").filter(pa.array(plain)).dictionary_encode()
        rest = unique.filter(pa.array(~plain))
        # the table of pieces: lowered stems, runs of marks, other words, and nothing
        table = [*self._find("plain", stems.dictionary.to_pylist()), *self._find("full", marks.dictionary.to_pylist()), *self._find("full", rest.to_pylist()), b""]
        first = np.empty(len(unique), np.int64)
        second = np.full(len(unique), len(table) - 1, np.int64)
        first[plain] = stems.indices.to_numpy()
        second[plain] = marks.indices.to_numpy() + len(stems.dictionary)
        first[~plain] = np.arange(len(rest)) + len(stems.dictionary) + len(marks.dictionary)
        flat = np.frombuffer(b"".join(table), "<u2")
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 2
        begins = np.cumsum(sizes) - sizes
        pieces = np.stack([first, second], axis=1)[code].ravel()
        size = sizes[pieces]
        ends = np.cumsum(size)
        out = flat[np.repeat(begins[pieces] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
        cuts = (2 * np.concatenate([[0], ends[1::2]])[np.concatenate([[0], np.cumsum(counts)])]).tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of an Arrow array; none for null."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy()
        block = (np.cumsum(sizes) - sizes) // BATCH_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(texts)] if len(texts) else [0]
        return [x for a, b in zip(cuts, cuts[1:]) for x in self._encode_batch(texts.slice(a, b - a))]


@lru_cache(maxsize=2)
def encoder_for(vocabulary: str) -> WordEncoder:
    """The encoder of this process; its memory outlives a task."""
    return WordEncoder(vocabulary)
