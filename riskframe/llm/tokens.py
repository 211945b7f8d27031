"""Token ids of whole texts by a public tokenizer, remembering words.

The word-BPE tokenizer encodes each run of non-blank characters by itself, so
the ids of a text are the ids of its runs one after another.  A worker keeps
the ids of runs it has met; new runs of letters go to the tokenizer together.
"""

from __future__ import annotations

import numpy as np

#: remembered runs in one worker; beyond it the memory starts anew
REMEMBERED = 400_000
#: ASCII marks that the tokenizer always splits from letters before them
MARKS = ".,!?;:%#&*$|"
#: texts from this length on are learned by themselves
LONG = 1_000_000
#: code points that Python splits at but the tokenizer does not
ODD_BREAKS = ("\x1c", "\x1d", "\x1e", "\x1f")


class WordIds:
    """Little-endian unsigned 32-bit ids of texts, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        # for lower-case ASCII words with blanks between them: nothing to normalise, nothing else to split at
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer, self.plain.pre_tokenizer = None, WhitespaceSplit()
        self.runs: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn_words(self, new: list[str], coder, home: dict[str, bytes]) -> None:
        coded = coder.encode(" ".join(new), add_special_tokens=False)
        ids, of = np.array(coded.ids, dtype="<u4"), np.array(coded.word_ids, dtype=np.int64)
        ends = np.flatnonzero(np.append(of[1:] != of[:-1], True)) + 1 if len(of) else np.zeros(0, np.int64)
        if len(ends) != len(new):
            for w in new:
                home[w] = self._direct(w)
            return
        raw, begin = ids.tobytes(), 0
        for w, end in zip(new, (ends * 4).tolist()):
            home[w] = raw[begin:end]
            begin = end

    def learn(self, runs: set[str]) -> None:
        """Remember the ids of all these runs."""
        if len(self.runs) + len(runs) > REMEMBERED:
            self.runs.clear()
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self.runs[""] = b""
        known, words = self.runs, self.words
        split, new, plain = [], set(), set()
        for run in runs.difference(known):
            if run.isascii() and run.isalpha():
                low = run.lower()
                if low not in known:
                    plain.add(low)
                if low != run:
                    split.append((run, low, "", known))
                continue
            word = run.rstrip(MARKS)
            if word.isalpha() and word and max(word) < "ƀ":
                low, tail = word.lower(), run[len(word):]
                # a lower-case ASCII word is a run itself
                home, wanted = (known, plain) if low.isascii() else (words, new)
                split.append((run, low, tail, home))
                if low not in home:
                    wanted.add(low)
                if tail and tail not in self.words:
                    self.words[tail] = self._direct(tail)
            else:
                self.runs[run] = self._direct(run)
        if plain:
            self._learn_words(list(plain), self.plain, known)
        if new:
            self._learn_words(list(new), self.tokenizer, words)
        for run, low, tail, home in split:
            known[run] = home[low] + words[tail] if tail else home[low]

    def learn_texts(self, texts) -> None:
        """Remember the runs of several texts with one call of the tokenizer."""
        runs: set[str] = set()
        for t in texts:
            if isinstance(t, str) and len(t) < LONG:
                runs.update(t.split())
        self.learn(runs)

    def counts(self, runs: list[str]) -> np.ndarray:
        """Numbers of tokens of these runs."""
        for _ in range(2):
            try:
                return np.fromiter(map(len, map(self.runs.__getitem__, runs)), np.int64, len(runs)) // 4
            except KeyError:
                self.learn(set(runs))
        return np.array([len(self._direct(r)) // 4 for r in runs])

    def ids(self, text: str) -> bytes:
        if any(c in text for c in ODD_BREAKS):
            return self._direct(text)
        runs = text.split()
        try:
            return b"".join(map(self.runs.__getitem__, runs))
        except KeyError:
            self.learn(set(runs))
        return b"".join(map(self.runs.__getitem__, runs))


_OPEN: dict[str, WordIds] = {}


def open_tokenizer(name_or_path: str) -> WordIds:
    """One per worker process and file; a bare name is looked up among the public tokenizers."""
    if name_or_path not in _OPEN:
        path = name_or_path
        if "/" not in name_or_path:
            import public_tokenizers
            path = public_tokenizers.path(name_or_path)
        _OPEN[name_or_path] = WordIds(path)
    return _OPEN[name_or_path]
