"""The search of J7 and J8 within one cell of the grid (``similarity``): numpy on the vectors of some
left and right texts, many left texts at a time.

For each gram a list has the right texts with it. A list is read as often as a left text needs it:

  * lists of few texts come first. Right texts that were not met can reach at most the sum, over the
    lists that follow, of weight times the largest weight in the list, and at most the product of the
    norms of what follows (Cauchy and Schwarz). Below what is asked for, reading ends;
  * a weight counts once with the list of the gram, as if the gram were there once, and what a text
    that repeats it has above that with a list of its own, so one such text loosens no bound;
  * where only the first k are asked for, the exact products of the best sums so far raise what is asked for;
  * of the texts that were met, those stay that what follows can still take there, by their own norms.
    While they are many, reading goes on; the few that stay get their exact products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

EPS = 1e-9
#: Sums that a batch of left texts has (a left text: one for each right text), left postings that are
#: prepared and pairs that are multiplied at once, and postings that are read in the time of one exact product.
SUMS = 4_000_000
CHUNK_POSTINGS = 200_000
PAIR_BLOCK = 16_384
EXACT = 8


def _unpack(batch: pa.RecordBatch):
    """Text ids, number of postings of each text, all gram ids and raw weights one after the other, norms."""
    ids, raw = batch.column("ids"), batch.column("ws")
    return (batch.column("text").to_numpy(), ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64),
            ids.flatten().to_numpy(), raw.flatten().to_numpy(), batch.column("norm").to_numpy())


def _ranges(starts, sizes):
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _rest(x, bounds):
    """For every number of a row the sum of it and those behind it in the row, or a little more."""
    last = x[::-1].copy()
    sums = np.add.reduceat(x, bounds[:-1])
    last[len(x) - bounds[1:-1]] -= sums[1:]  # each row starts at 0 again
    return np.cumsum(last)[::-1] + len(x) * np.finfo(np.float64).eps * sums.max()


def _once(keys):
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def _rank(row, value):
    """Place of each value in its row, the largest first; rows are in order."""
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else row
    rank = np.empty(len(row), np.int64)
    rank[np.lexsort((-value, row))] = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    return rank


class _Index:
    """Right texts of a cell: their vectors, and the lists of the grams. List g has the texts with gram g,
    as if it were there once; list n + g those that have more of it, with the weight of that."""

    def __init__(self, table: pa.Table):
        self.texts, self.lens, ids, raw, self.norm = _unpack(table.combine_chunks().to_batches()[0])
        self.bounds = np.cumsum(self.lens) - self.lens
        self.weight = raw / np.repeat(self.norm, self.lens)
        self.own_norm = np.sqrt(np.add.reduceat(self.weight * self.weight, self.bounds))
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        sizes = np.diff(np.append(first, len(ids)))
        self.grams, self.n = ids[first], len(first)
        of = np.repeat(np.arange(self.n, dtype=np.int32), sizes)
        self.gram = np.empty_like(of)
        self.gram[order] = of
        del ids
        raw = raw[order]
        least = np.minimum.reduceat(raw, first)
        raw -= least[of]
        more = np.flatnonzero(raw > 0)
        rows = np.repeat(np.arange(len(self.texts), dtype=np.int32), self.lens)[order]
        del order
        self.sizes = np.append(sizes, np.bincount(of[more], minlength=self.n))
        self.starts = np.cumsum(self.sizes) - self.sizes
        some = np.flatnonzero(self.sizes)
        self.rows = np.append(rows, rows[more])
        self.part = np.append(least[of], raw[more])
        del of, raw, rows
        self.most_raw, self.most = np.zeros(2 * self.n), np.zeros(2 * self.n)
        self.most_raw[some] = np.maximum.reduceat(self.part, self.starts[some])
        self.part /= self.norm[self.rows]
        self.most[some] = np.maximum.reduceat(self.part, self.starts[some])


class _Batch:
    """Some left texts: their grams (numbers of the index) and weights, and their lists, those of few texts first."""

    def __init__(self, index: _Index, sums, dense, vectors, lists, bound: float, k: int | None, hot: int, seeds: int):
        self.x, self.sums, self.dense, self.k, self.hot, self.seeds = index, sums, dense, k, hot, seeds
        bounds, gram, weight = vectors
        self.n, self.width = len(bounds) - 1, len(index.texts)
        self.at_dense = np.repeat(np.arange(self.n) * index.n, np.diff(bounds)) + gram
        dense[self.at_dense] = weight
        bounds, self.list, self.w = lists
        self.size = index.sizes[self.list]
        self.before = np.append(0, np.cumsum(self.size))  # postings in the lists before each
        self.first, self.end = bounds[:-1], bounds[1:]
        self.row = np.repeat(np.arange(self.n), np.diff(bounds))
        # of each list and those behind it; nothing is behind the last
        self.rest_raw = np.append(_rest(self.w * index.most_raw[self.list], bounds), 0.0)
        self.rest_norm = np.append(np.sqrt(_rest(self.w * self.w, bounds)), 0.0)
        self.unmet = np.minimum(_rest(self.w * index.most[self.list], bounds), self.rest_norm[:-1] * index.own_norm.max())
        self.at, self.bound = self.first.copy(), np.full(self.n, bound)

    def clear(self, read):
        for keys in read:
            self.sums[keys] = 0.0
        self.dense[self.at_dense] = 0.0

    def add(self, rows, to):
        """Reads lists of the rows up to the given ones; the keys (row times width, and right text) that they have."""
        n = to - self.at[rows]
        lists = _ranges(self.at[rows], n)
        size = self.size[lists]
        at = _ranges(self.x.starts[self.list[lists]], size)
        keys = self.x.rows[at] + np.repeat(np.repeat(rows * self.width, n), size)
        np.add.at(self.sums, keys, self.x.part[at] * np.repeat(self.w[lists], size))
        self.at[rows] = to
        return keys

    def split(self, keys):
        row = keys // self.width  # much faster than divmod
        return row, keys - row * self.width

    def exact(self, keys):
        row, right = self.split(keys)
        out = []
        for at in range(0, len(keys), PAIR_BLOCK):
            i, r = row[at:at + PAIR_BLOCK], right[at:at + PAIR_BLOCK]
            n = self.x.lens[r]
            post = _ranges(self.x.bounds[r], n)
            out.append(np.add.reduceat(self.dense[np.repeat(i * self.x.n, n) + self.x.gram[post]] * self.x.weight[post], np.cumsum(n) - n))
        return np.concatenate(out) if out else np.empty(0)

    def raise_bounds(self, keys, score):
        """By the k-th of the scores of each row; keys are in order."""
        row = keys // self.width
        kth = _rank(row, score) == self.k - 1
        self.bound[row[kth]] = np.maximum(self.bound[row[kth]], score[kth] - 2 * EPS)

    def seed(self, keys):
        keys = _once(keys)
        keys = keys[_rank(keys // self.width, self.sums[keys]) < self.seeds * self.k]
        self.raise_bounds(keys, self.exact(keys))

    def behind(self):
        """Of each row: what follows, by raw weights and as a norm."""
        ended = self.at == self.end
        return np.where(ended, 0.0, self.rest_raw[self.at]), np.where(ended, 0.0, self.rest_norm[self.at])

    def near(self, keys):
        row, right = self.split(keys)
        raw, norm = self.behind()
        reach = self.sums[keys] + np.minimum(raw[row] / self.x.norm[right], norm[row] * self.x.own_norm[right])
        return keys[reach >= self.bound[row] - EPS]

    def upto(self, rows, postings, most):
        """The lists up to which the rows have so many postings to read, one at least and not behind ``most``."""
        to = np.searchsorted(self.before, self.before[self.at[rows]] + postings, side="right") - 1
        return np.minimum(np.maximum(to, self.at[rows] + 1), most)

    def alone(self, row):
        """Keys of one row that has read much or is about to, in order."""
        mine = slice(row * self.width, (row + 1) * self.width)
        asked, rows = self.before[self.at[row]] - self.before[self.first[row]], np.array([row])
        found = lambda: np.flatnonzero(self.sums[mine]) + row * self.width
        while (j := self.at[row]) < self.end[row] and self.unmet[j] >= self.bound[row] - EPS:
            read = self.before[j] - self.before[self.first[row]]
            if self.k and self.size[j] > self.hot and read >= max(self.k, 2 * asked):
                self.seed(found())
                asked = read
            else:
                self.add(rows, rows * 0 + j + 1)
        keys = self.near(found())
        if self.k:
            self.seed(keys)
            keys = self.near(keys)
        while (j := self.at[row]) < self.end[row] and len(keys) * EXACT > self.size[j]:
            to = self.upto(rows, len(keys) * EXACT, self.end[rows])[0]
            while self.at[row] < to:
                self.add(rows, self.at[rows] + 1)
            keys = self.near(keys)
        self.sums[mine] = 0.0
        return keys

    def search(self):
        """Rows, right texts and scores."""
        most = max(4 * self.hot, self.width // 4)  # postings that a row reads together with others
        read, single = [], np.zeros(self.n, bool)
        live, postings = np.arange(self.n), np.full(self.n, self.hot)
        while True:
            needed = self.first + np.add.reduceat(self.unmet >= self.bound[self.row] - EPS, self.first, dtype=np.int64)
            live = live[self.at[live] < needed[live]]
            to = self.upto(live, postings[live], needed[live])
            over = self.before[to] - self.before[self.first[live]] > most
            single[live[over]] = True
            live, to = live[~over], to[~over]
            if not len(live):
                break
            n = self.before[to] - self.before[self.at[live]]
            keys = self.add(live, to)
            read.append(keys)
            postings[live] = 3 * (self.before[to] - self.before[self.first[live]])
            if self.k == 1:
                sums = self.sums[keys]
                self.seed(keys[sums == np.repeat(np.maximum.reduceat(sums, np.cumsum(n) - n), n)])
            elif self.k:
                keys = np.concatenate(read)
                asked = np.zeros(self.n, bool)
                asked[live] = True
                self.seed(keys[asked[keys // self.width]])
        keys = np.concatenate(read) if read else np.empty(0, np.int64)
        raw, norm = self.behind()
        least = self.bound - EPS - np.minimum(raw / self.x.norm.min(), norm * self.x.own_norm.max())
        least[single] = np.inf
        keys = self.near(_once(keys[self.sums[keys] >= least[keys // self.width]]))
        while True:  # reading narrows down what is left, where that is cheaper than exact products
            size = np.where(self.at < self.end, self.size[np.minimum(self.at, len(self.size) - 1)], 0)
            todo = EXACT * np.bincount(keys // self.width, minlength=self.n)
            rows = np.flatnonzero((todo > size) & (size > 0) & (size <= most))
            if not len(rows):
                break
            read.append(self.add(rows, self.upto(rows, np.minimum(todo[rows], most), self.end[rows])))
            keys = self.near(keys)
        keys = np.sort(np.concatenate([keys, *(self.alone(row) for row in np.flatnonzero(single))]))
        score = self.exact(keys)
        if self.k:
            self.raise_bounds(keys, score)
        self.clear(read)
        row, right = self.split(keys)
        keep = score >= self.bound[row]
        return row[keep], right[keep], score[keep]


def _chunks(left: pa.Table):
    for batch in left.to_batches():
        ends = np.cumsum(batch.column("ids").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            to = max(at + 1, np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_POSTINGS, side="right"))
            yield batch.slice(at, to - at)
            at = to


def cell_search(least: float, k: int | None, hot: int, seeds: int):
    """The search within a cell of the grid: of each left text the right texts with a product of
    ``least`` or more (with 0: that share a gram), and with k only those that are not behind k others
    by more than rounding (2 EPS). A left text that has read ``hot`` postings finds its own threshold
    from exact products, those of ``seeds`` texts for each of the k."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)])
        if left.num_rows and right.num_rows:
            x = _Index(right)
            together = max(1, min(256, SUMS // max(x.n, len(x.texts))))
            sums, dense = np.zeros(together * len(x.texts)), np.zeros(together * x.n)
            for chunk in _chunks(left):
                texts, lens, ids, raw, norm = _unpack(chunk)
                gram = np.minimum(np.searchsorted(x.grams, ids), x.n - 1)
                met = np.flatnonzero(x.grams[gram] == ids)
                row = np.repeat(np.arange(len(texts)), lens)[met]
                gram, weight = gram[met], raw[met] / norm[row]
                more = np.flatnonzero(x.sizes[x.n + gram])
                lists, of, w = np.append(gram, x.n + gram[more]), np.append(row, row[more]), np.append(weight, weight[more])
                order = np.argsort(of << 40 | x.sizes[lists])
                lists, of, w = lists[order], of[order], w[order]
                some = _once(row)
                for at in range(0, len(some), together):
                    rows = some[at:at + together]
                    parts = []
                    for r, *columns in ((row, gram, weight), (of, lists, w)):
                        bounds = np.append(np.searchsorted(r, rows), np.searchsorted(r, rows[-1], side="right"))
                        parts.append((bounds - bounds[0], *(c[bounds[0]:bounds[-1]] for c in columns)))
                    l, r, score = _Batch(x, sums, dense, *parts, least, k, hot, seeds).search()
                    for column, values in zip(found, (texts[rows[l]], x.texts[r], score)):
                        column.append(values)
        return pa.table({name: np.concatenate(x) for name, x in zip(("ltext", "rtext", "score"), found)})

    return search
