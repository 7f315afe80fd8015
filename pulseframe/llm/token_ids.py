"""Token ids of many texts by a public tokenizer, with the ids of frequent words kept at hand."""

from __future__ import annotations

import os

import numpy as np

#: Words whose ids a worker keeps; it starts anew when they are exceeded.
MOST_WORDS = 200_000
#: Longer words are not kept.
LONGEST_WORD = 48
WORDS_AT_ONCE = 5000

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids as little-endian unsigned 32-bit numbers, without special tokens added.

    A byte-level pre-tokenizer never joins a word with what follows a single space or line feed
    between two other characters, so such words are encoded apart and their ids are
    remembered. Texts with other white space at a word's edge are encoded whole.

    `ranks` may name the same vocabulary as a table of ranks, with the `pattern` that splits words. It
    gives the same ids in a third of the time and is then used for words.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ranked = None
        if ranks is not None:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes] = {}
        (self.feed,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _ids_of_lines(self, lines: str) -> list[int]:
        if self.ranked is not None:
            return self.ranked.encode_ordinary(lines)
        return self.tokenizer.encode_batch_fast([lines], add_special_tokens=False)[0].ids

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Of words without line feeds: many in one text, a line each, cut again at the feeds' ids."""
        out: list[bytes] = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            lines = "\n".join(words[at : at + WORDS_AT_ONCE])
            ids = np.array(self._ids_of_lines(lines), dtype="<u4")
            ends = np.append(np.flatnonzero(ids == self.feed), len(ids)).tolist()
            data, start = ids.tobytes(), 0
            for end in ends:
                out.append(data[4 * start : 4 * end])
                start = end + 1
        return out

    def _words(self, text: str) -> list[str] | None:
        """Words, each with the space or line feed before it; None if the text has to stay whole."""
        words = []
        for n, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            for p in parts:
                if not p or p[0].isspace() or p[-1].isspace():
                    return None
            if n:
                words.append("\n")
            words.append(parts[0])
            words += [" " + p for p in parts[1:]]
        return words

    def batch(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > MOST_WORDS or not self.known:
            self.known.clear()
            self.known["\n"] = self.feed.to_bytes(4, "little")
        split = [None if any(s in t for s in self.special) else self._words(t) for t in texts]
        known = self.known
        seen: set[str] = set()
        for words in split:
            if words is not None:
                seen.update(words)
        missing = [w for w in seen if w not in known]
        fresh = dict(zip(missing, self._encode_words(missing))) if missing else {}
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST_WORD)
        whole = [t for t, words in zip(texts, split) if words is None]
        whole_ids = iter(self._encode(whole)) if whole else iter(())
        rare = {w: ids for w, ids in fresh.items() if len(w) > LONGEST_WORD}
        out = []
        for words in split:
            if words is None:
                out.append(next(whole_ids))
            elif rare:
                out.append(b"".join([known[w] if w in known else rare[w] for w in words]))
            else:
                out.append(b"".join(map(known.__getitem__, words)))
        return out


def encoder(path: str | None) -> Encoder:
    """One for each file in a worker; by default that of the public byte-level BPE."""
    name = path or ""
    if name not in _encoders:
        if path is None:
            import public_tokenizers

            files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
            _encoders[name] = Encoder(*files, public_tokenizers.PATTERN)
        else:
            _encoders[name] = Encoder(path)
    return _encoders[name]
