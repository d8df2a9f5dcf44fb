"""A prefix tree over ordered sets, and the similarity join of the sets in it."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np


class _Groups:
    """Which sets are known to be connected."""

    def __init__(self, labels: np.ndarray):
        self.label = labels

    def unite(self, members: list[int]) -> None:
        self.label[np.isin(self.label, self.label[members])] = self.label[members[0]]


class Trie:
    """Sets as rising runs of ranks; sets that begin alike share the nodes of their beginning.

    Sets are kept in lexical order, so the sets below a node are a range of positions.  A node
    holds the run of ranks from its parent on, the number of ranks above and in it, the range of
    its sets and the least and largest size among them.
    """

    def __init__(self, sets: list[np.ndarray]):
        """sets: in lexical order, no two alike."""
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        n = len(sets)
        shared = np.zeros(n + 1, np.int64)  # of each set with the one before it
        for i in range(1, n):
            a, b = sets[i - 1], sets[i]
            k = min(len(a), len(b))
            other = np.flatnonzero(a[:k] != b[:k])
            shared[i] = other[0] if len(other) else k
        self.nodes: list[tuple] = []
        self.root = self._build(0, n, shared)

    def _build(self, lo: int, hi: int, shared: np.ndarray) -> int:
        """The tree of sets lo to hi, made with a stack, since it can be deep."""
        root = len(self.nodes)
        self.nodes.append(None)
        work = [(root, lo, hi, 0)]
        while work:
            place, lo, hi, above = work.pop()
            inside = shared[lo + 1:hi]
            depth = int(inside.min()) if hi - lo > 1 else len(self.sets[lo])
            ends_here = len(self.sets[lo]) == depth
            children = []
            if hi - lo > 1:
                first = lo + 1 if ends_here else lo
                cuts = [first] + [c for c in (np.flatnonzero(shared[first + 1:hi] == depth)
                                              + first + 1).tolist()] + [hi]
                for a, b in zip(cuts, cuts[1:]):
                    children.append(len(self.nodes))
                    self.nodes.append(None)
                    work.append((children[-1], a, b, depth))
            sizes = self.sizes[lo:hi]
            self.nodes[place] = (self.sets[lo][above:depth], depth, lo, hi, int(sizes.min()),
                                 int(sizes.max()), lo if ends_here else -1, children)
        return root

    def matches(self, query: int, labels: np.ndarray, breaks: np.ndarray, members: np.ndarray,
                percent: int) -> list[int]:
        """The sets after `query` that are similar to it and not yet connected with it.

        members: of all ranks, those in the query.  breaks: how many changes of label there are
        up to each position, which tells a subtree that is connected with the query throughout.
        """
        ranks = self.sets[query]
        size, own, found = len(ranks), labels[query], []
        listed = ranks.tolist()
        work = [(self.root, 0)]
        while work:
            place, overlap = work.pop()
            run, depth, lo, hi, least, most, ends, children = self.nodes[place]
            if hi <= query + 1:
                continue
            low = max(lo, query + 1)
            if labels[low] == own and breaks[hi - 1] == breaks[low]:
                continue
            if len(run):
                overlap += int(np.count_nonzero(members[run]))
                rest = size - bisect_right(listed, int(run[-1]))
            else:
                rest = size
            # The size below at which the most can still be shared for what is needed.
            best = min(max(depth + rest, least), most)
            if (100 + percent) * (overlap + min(best - depth, rest)) < percent * (size + best):
                continue
            if ends > query and labels[ends] != own and (
                    100 * overlap >= percent * (size + depth - overlap)):
                found.append(ends)
            work.extend((c, overlap) for c in children)
        return found


def connect(sets: list[np.ndarray], labels: list | None = None,
            percent: int = 75) -> list[tuple[int, int]]:
    """Links (i, j) between similar sets, as many as are needed to connect all that are.

    sets: distinct sorted hashes, none empty.  Two are similar when 100 * shared >= percent *
    united.  labels: sets of equal label are known to be connected.

    The elements are ranked by falling frequency among these sets, then by hash, so that similar
    sets begin alike.  A subtree is left when too few elements remain for the overlap needed, or
    when the query is connected with all of it.
    """
    every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True,
                                       return_counts=True)
    rank = np.empty(len(every), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(every))
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    ranked = [np.sort(r) for r in np.split(rank[inverse], cuts)]
    keys = [r.astype(">u4").tobytes() for r in ranked]
    order = sorted(range(len(sets)), key=keys.__getitem__)
    links, kept, source = [], [], []
    for i in order:
        if source and keys[i] == keys[source[-1]]:
            links.append((source[-1], i))  # alike
        else:
            source.append(i)
            kept.append(ranked[i])
    known = {}
    start = np.arange(len(kept))
    if labels is not None:
        start = np.array([known.setdefault(labels[i], p) for p, i in enumerate(source)])
    groups = _Groups(start)
    trie = Trie(kept)
    members = np.zeros(len(every), bool)

    def changes() -> np.ndarray:
        return np.concatenate([[0], np.cumsum(groups.label[1:] != groups.label[:-1])])

    breaks = changes()
    for query in range(len(kept) - 1):
        members[kept[query]] = True
        found = trie.matches(query, groups.label, breaks, members, percent)
        members[kept[query]] = False
        if found:
            links += [(source[query], source[f]) for f in found]
            groups.unite([query, *found])
            breaks = changes()
    return links
