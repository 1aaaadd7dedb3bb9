"""Substring dedup over words with suffix automata of reference shards.

``repeats`` gathers in a shard all snippets that can share a window. The shard's automaton, built once over its
distinct snippets, serves every occurrence of them in the corpus: it knows how often each word sequence occurs, and
snippets are streamed through it for matching statistics, the longest sequence ending at each word that occurs
twice. Windows that such a sequence covers are repeated. Shards are made where their documents are matched, so
nothing of the size of the corpus is sent to every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .repeats import Unit, repeated

WINDOW = 35
SHARD_BYTES = 1 << 18


class Automaton:
    """Suffix automaton over several sequences with the number of occurrences of each state."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.weight: list[int] = [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.next) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of ``q`` for the shorter sequences that also end elsewhere."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, weight: int) -> None:
        """Add a sequence that occurs ``weight`` times."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for word in words:
            q = nxt[last].get(word)
            if q is not None:
                # Some sequence added before goes on in this way.
                last = q if length[q] == length[last] + 1 else self._split(last, word, q)
            else:
                p = last
                last = self._state(length[p] + 1, 0, {})
                while p >= 0 and word not in nxt[p]:
                    nxt[p][word] = last
                    p = link[p]
                if p >= 0:
                    q = nxt[p][word]
                    link[last] = q if length[q] == length[p] + 1 else self._split(p, word, q)
            self.weight[last] += weight

    def settle(self) -> None:
        """Pass the numbers of occurrences on to shorter sequences."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.weight[self.link[s]] += self.weight[s]

    def statistics(self, words: list) -> list[int]:
        """Length of the longest sequence ending at each word that occurs at least twice."""
        nxt, link, length, weight = self.next, self.link, self.length, self.weight
        state = size = 0
        out = []
        for word in words:
            to = nxt[state].get(word, 0)
            while (not to or weight[to] < 2) and state:
                state = link[state]
                size = length[state]
                to = nxt[state].get(word, 0)
            if to and weight[to] >= 2:
                state, size = to, size + 1
            else:
                state = size = 0
            out.append(size)
        return out


def match(shard: list[tuple[bytes, int]], window: int = WINDOW) -> list[list[tuple[int, int]]]:
    """Runs of windows of each snippet that occur at least twice in the shard."""
    automaton = Automaton()
    split = [text.split(b" ") for text, _ in shard]
    for words, (_, weight) in zip(split, shard):
        automaton.add(words, weight)
    automaton.settle()
    out = []
    for words in split:
        runs: list[tuple[int, int]] = []
        begin = None
        for at, size in enumerate(automaton.statistics(words)):
            start = at - window + 1
            if size >= window:
                begin = start if begin is None else begin
            elif begin is not None:
                runs.append((begin, start))
                begin = None
        if begin is not None:
            runs.append((begin, len(words) - window + 1))
        out.append(runs)
    return out


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, n (words), n_removed, n_spans, kept_sha256 of every row.

    A word goes if a window of 35 words over it starts anywhere else as well, in another row or the same; all
    copies go. Null texts have no words; repeated rows repeat each other; further columns are ignored; an empty
    table gives no rows.
    """
    return repeated(docs, Unit(words=True, window=WINDOW, gram=8, longest=512), match, SHARD_BYTES)
