"""Titles of a block, by the trigrams they hold, and the best runs of them for a query."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Trigrams of a run that are looked at, from each beginning on; titles with more than LONG are tried one by one.
WIDE, LONG = 128, 256


def best_run(t: list[str], asked: set[str]) -> float:
    """The best share of asked in any run of trigrams t: runs grow by one shared trigram at a time."""
    at, best = [i for i, x in enumerate(t) if x in asked], 0.0
    for k, a in enumerate(at):
        run, both, upto = set(), set(), a
        for b in at[k:]:
            run.update(t[upto : b + 1])
            both.add(t[b])
            upto = b + 1
            best = max(best, len(both) / (len(run) + len(asked) - len(both)))
    return best


class Titles:
    """Titles (id, text in lower case, trigrams in order): where each trigram stands, and how many differ in each stretch from each place on."""

    def __init__(self, ids: np.ndarray, lower: pa.Array, grams: pa.ListArray):
        self.ids, self.lower, self.grams = ids, lower, grams
        coded = grams.flatten().dictionary_encode()
        self.codes = {g: k for k, g in enumerate(coded.dictionary.to_pylist())}
        code = coded.indices.to_numpy(zero_copy_only=False)
        many = pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)
        places, self.title = np.arange(len(code)), np.repeat(np.arange(len(ids)), many)
        order = np.lexsort((places, code, self.title))
        again = np.r_[False, (code[order][1:] == code[order][:-1]) & (self.title[order][1:] == self.title[order][:-1])] if len(code) else np.zeros(0, bool)
        self.before = np.full(len(code), -1)  # the place before of the same trigram in the same title
        self.before[order[again]] = order[np.flatnonzero(again) - 1]
        self.at = np.argsort(code, kind="stable")
        self.begins = np.searchsorted(code[self.at], np.arange(len(self.codes) + 1))
        # Rows of those places whose title is not long, and differing trigrams up to each distance.
        short = many[self.title] <= LONG
        self.row = np.cumsum(short) - 1
        p, wide = places[short], min(WIDE, int(many.max(initial=1)))
        ends = (np.cumsum(many)[self.title])[short]
        self.differ = np.zeros((len(p), wide), np.uint8)
        for d in range(wide):
            there = np.minimum(p + d, max(len(code) - 1, 0))
            self.differ[:, d] = (self.differ[:, d - 1] if d else 0) + ((p + d < ends) & (self.before[there] < p))
        # Stretches of more than WIDE places hold this many differing ones at least.
        self.beyond = np.where(many > LONG, 0, np.iinfo(np.int64).max)
        if wide == WIDE:
            full = p + WIDE <= ends
            np.minimum.at(self.beyond, self.title[short][full], self.differ[full, -1].astype(np.int64))

    def places(self, gram: str) -> np.ndarray:
        k = self.codes.get(gram)
        return self.at[self.begins[k] : self.begins[k + 1]] if k is not None else self.at[:0]

    def best(self, query: str, asked: list[str], least: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best titles: those of a score from least on, and those that hold the query, whatever theirs."""
        n, score = len(asked), np.full(len(self.ids), -1.0)
        stand = np.sort(np.concatenate([self.places(g) for g in asked])) if n else self.at[:0]
        shared = np.bincount(self.title[stand[self.before[stand] < 0]], minlength=len(self.ids))
        enough = shared >= max(1, math.ceil(n * least - 1e-9))
        near = n / least + 1e-9 if least > 0 else math.inf
        fast = enough & (self.beyond > near)
        self._grow(stand[fast[self.title[stand]]], n, near, score)
        score[score < least] = -1.0
        for k in np.flatnonzero(enough & ~fast).tolist():
            own = best_run(self.grams[k].as_py(), set(asked))
            score[k] = own if own >= least else -1.0
        for k in self._holding(query, asked):
            if score[k] < 0:
                score[k] = best_run(self.grams[k].as_py(), set(asked)) if n else 0.0
        got = np.flatnonzero(score >= 0)
        got = got[np.lexsort((self.ids[got], -score[got]))][:limit]
        return self.ids[got], score[got]

    def _grow(self, stand: np.ndarray, n: int, near: float, score: np.ndarray) -> None:
        """Runs from each place of a shared trigram on grow by one shared one at a time, all at once, while so few trigrams differ in them."""
        title, both, a = self.title[stand], np.zeros(len(stand), np.int64), np.arange(len(stand))
        best, d = np.zeros(len(stand)), 0
        while len(a):
            begin, end = stand[a], stand[a + d]
            both[a] += self.before[end] < begin
            run = self.differ[self.row[begin], end - begin].astype(np.int64)
            best[a] = np.maximum(best[a], both[a] / (run + n - both[a]))
            d += 1
            a = a[(run <= near) & (a + d < len(stand))]
            a = a[(title[a + d] == title[a]) & (stand[a + d] - stand[a] < self.differ.shape[1])]
        np.maximum.at(score, title, best)

    def _holding(self, query: str, asked: list[str]) -> list[int]:
        """Titles that hold the query: they hold its trigrams that have no word's edge in them; if it has none, each is looked at."""
        inner = [g for g in asked if " " not in g]
        if not inner:
            return np.flatnonzero(pc.match_substring(self.lower, query).to_numpy(zero_copy_only=False)).tolist()
        rare = min((self.places(g) for g in inner), key=len)
        return [k for k in np.unique(self.title[rare]).tolist() if query in self.lower[k].as_py()]
