"""Exact best matches between two sets of vectors, without a row per pair.

All pairs of two large sets cannot be written out, and an inverted join writes them for every common
feature. The right side is cut into blocks of like rows, and of every block a few numbers are kept that bound
the product of any vector with its rows. A left row first meets the one block with the largest bound, which gives it
a floor, the score of its k-th match so far. Then it meets only the blocks whose bound reaches its floor.
Rows meet a block in tasks of bounded size, where matrix products score them in memory and only the
best ``k`` per left row leave the task. Nothing is left out: a block that is skipped has no better row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from recflow.functions import comparable
from recflow.operators.joins import lookup
from recflow.operators.ranking import top_list_rows
from recflow.session import drop_paths, materialize, materialize_at, ship_functions

ship_functions(__name__)

# A task holds so many rows of each side.
MAX_BLOCK_ROWS = 32_768
# Smaller blocks than this are not worth a task.
MIN_BLOCK_ROWS = 512
# Blocks of the right side, so far as they need not be smaller or larger than above.
FINE_BLOCKS = 256
# Features of a block whose values are kept for its bound, and how much wider bounds are taken.
COMMON = 64
# Kinds of features whose lengths are bounded apart.
PARTS = 8
BOUND_SLACK = 1e-9
# Rows that one round of a matching moves, in those of both sides.
COPIES = 8
# Tasks of one matching; with more pairs of blocks, a task takes several, one after the other.
MAX_TASKS = 20_000
# Left and right rows multiplied at once inside a task, fewer where their features fill more bytes.
LEFT_ROWS, RIGHT_ROWS = 512, 2048
# Rows up to this length, and from its inverse on, are first multiplied in single precision.
LONGEST = 1e12
FIRST_ROWS = 512
DENSE_BYTES = 32 << 20
# Where more than one of so many products might get in, all are taken again in double precision.
MANY_HITS = 64
# A row that another one meets in a join is written and scored at the cost of so many pairs of rows in a block, which for
# every twenty columns cost as much again.
MET_COST = 200
COLUMNS_COST = 20
# Scores equal to this many digits, counted from the leading one, are ties, which go to the smaller id.
SCORE_DIGITS = 12


class _Vectors:
    """The rows of a block as dense matrices, built a few rows and only the needed features at a time."""

    def __init__(self, block: pd.DataFrame, names: pd.Index | None = None):
        self.dense = np.stack(block["vec"].to_numpy()) if "vec" in block.columns else None
        if self.dense is not None:
            return
        flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in block["dims"]])
        self.values = np.concatenate([np.asarray(x, dtype=float) for x in block["vals"]])
        self.ends = np.concatenate([[0], np.cumsum(block["dims"].map(len).to_numpy())])
        codes, own = pd.factorize(flat)
        self.names = pd.Index(own) if names is None else names
        # a feature the other side lacks scores nothing and gets -1
        known = np.arange(len(own)) if names is None else names.get_indexer(pd.Index(own))
        self.codes = known[codes] if len(own) else codes

    def take(self, some: np.ndarray) -> _Vectors:
        """Some of the rows."""
        out = object.__new__(_Vectors)
        out.dense = None if self.dense is None else self.dense[some]
        if out.dense is None:
            sizes = np.diff(self.ends)[some]
            out.ends, out.names = np.concatenate([[0], np.cumsum(sizes)]), self.names
            cell = np.repeat(self.ends[some] - out.ends[:-1], sizes) + np.arange(out.ends[-1])
            out.codes, out.values = self.codes[cell], self.values[cell]
        return out

    def features(self, start: int, stop: int) -> np.ndarray | None:
        """The feature codes that occur in some rows."""
        if self.dense is not None:
            return None
        return np.unique(self.codes[self.ends[start] : self.ends[stop]])

    def rows(self, start: int, stop: int, features: np.ndarray | None) -> np.ndarray:
        if self.dense is not None:
            return self.dense[start:stop]
        at, end = self.ends[start], self.ends[stop]
        matrix = np.zeros((stop - start, len(features)))
        if not len(features) or at == end:
            return matrix
        codes = self.codes[at:end]
        place = np.minimum(np.searchsorted(features, codes), len(features) - 1)
        hit = features[place] == codes
        row = np.repeat(np.arange(stop - start), np.diff(self.ends[start : stop + 1]))
        matrix[row[hit], place[hit]] = self.values[at:end][hit]
        return matrix


def _first_digits(scores: np.ndarray) -> np.ndarray:
    """Scores cut to ``SCORE_DIGITS`` digits from the leading one, so that sums in any order tie."""
    size = np.abs(scores)
    plain = (size < 1e-290) | (size > 1e290)
    unit = 10.0 ** (SCORE_DIGITS - 1 - np.floor(np.log10(np.where(plain, 1.0, size))))
    return np.where(plain, scores, np.rint(scores * unit) / unit)


def _around(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a score must reach to have the first digits of these, and to have larger ones."""
    size = np.abs(scores)
    plain = (size < 1e-290) | (size > 1e290)
    unit = 10.0 ** (SCORE_DIGITS - 1 - np.floor(np.log10(np.where(plain, 1.0, size))))
    digits = np.rint(np.where(plain, 0.0, scores) * unit)
    return np.where(plain, scores, (digits - 0.5) / unit), np.where(plain, scores, (digits + 0.5) / unit)


def _improve(
    scores: np.ndarray, columns: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The best so far, updated with some scores; a later column loses every tie."""
    new, last = _first_digits(value), _first_digits(scores[:, -1])[row]
    above = (new > last) | ((new == last) & (column < columns[:, -1][row]))
    touched, row = np.unique(row[above], return_inverse=True)
    if not len(touched):
        return scores, columns
    n, k = len(touched), scores.shape[1]
    rows = np.concatenate([np.repeat(np.arange(n), k), row])
    values = np.concatenate([scores[touched].ravel(), value[above]])
    places = np.concatenate([columns[touched].ravel(), column[above]])
    sorted_ = np.lexsort((places, -_first_digits(values), rows))
    take = sorted_[np.searchsorted(rows[sorted_], np.arange(n))[:, None] + np.arange(k)]
    scores, columns = scores.copy(), columns.copy()
    scores[touched], columns[touched] = values[take], places[take]
    return scores, columns


class _Panel:
    """Right rows that are multiplied with many left rows: in single precision, which tells most of them from the best."""

    def __init__(self, rows: _Vectors, at: int, end: int, features: np.ndarray | None, numbers: np.ndarray):
        self.own, self.at, self.size, self.features = rows, at, end - at, features
        self.numbers = numbers
        squares, quick = np.zeros(self.size), None
        for start in range(0, self.size, LEFT_ROWS):
            stop = min(start + LEFT_ROWS, self.size)
            exact = self.exact(start, stop)
            quick = np.empty((self.size, exact.shape[1]), np.float32) if quick is None else quick
            with np.errstate(over="ignore"):
                quick[start:stop], squares[start:stop] = exact, (exact * exact).sum(axis=1)
        self.quick, self.width = quick, quick.shape[1]
        self.longest = float(np.sqrt(squares.max()))
        if features is not None:
            # the column of each cell, -1 for a feature that the left side lacks
            codes = rows.codes[rows.ends[at] : rows.ends[end]]
            place = np.minimum(np.searchsorted(features, codes), max(0, len(features) - 1))
            known = features[place] == codes if len(features) else np.zeros(len(codes), bool)
            self.place = np.where(known, place, -1)

    def exact(self, start: int, stop: int) -> np.ndarray:
        return self.own.rows(self.at + start, self.at + stop, self.features)

    def products(self, rows: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """The products of some pairs of a left row and a row of the panel, in double precision."""
        out = np.empty(len(row))
        step = max(1, DENSE_BYTES // (32 * max(1, self.width)))
        for a in range(0, len(row), step):
            some, right = row[a : a + step], column[a : a + step] + self.at
            if self.own.dense is not None:
                out[a : a + step] = np.einsum("ij,ij->i", rows[some], self.own.dense[right])
                continue
            sizes = self.own.ends[right + 1] - self.own.ends[right]
            pair = np.repeat(np.arange(len(some)), sizes)
            cell = np.arange(len(pair)) + np.repeat(self.own.ends[right] - (np.cumsum(sizes) - sizes), sizes)
            place = self.place[cell - self.own.ends[self.at]]
            hit = place >= 0
            pair, cell, place = pair[hit], cell[hit], place[hit]
            out[a : a + step] = np.bincount(pair, self.own.values[cell] * rows[some[pair], place], len(some))
        return out

    def best(
        self, rows: np.ndarray, floor: np.ndarray, until: np.ndarray, scores: np.ndarray, columns: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The best so far of some left rows, updated with the rows of the panel.

        Scores below ``floor`` may be left out, and those equal to it of columns from ``until`` on. Every score that is
        kept is added up in the order of its right row, so that like rows tie.
        """
        wanted = scores.shape[1]
        lengths = np.sqrt((rows * rows).sum(axis=1))
        # outside these, single precision has too few digits or none
        single = max(lengths.max(), self.longest) < LONGEST and min(lengths.max(), self.longest) > 1 / LONGEST
        most = lengths * self.longest
        terms = int((rows != 0).sum(axis=1).max()) + 4
        margin = most * terms * 2.0**-23 + 1e-30 if single else np.zeros(len(rows))
        left = rows.astype(np.float32) if single else rows
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cut, at = None, 0
        while at < self.size:
            # a short first chunk sets a bar that most later scores do not reach
            end = min(at + (RIGHT_ROWS if at else FIRST_ROWS), self.size)
            fresh = left @ (self.quick[at:end] if single else self.exact(at, end)).T
            if not single:
                fresh[np.isnan(fresh)] = -np.inf
            if cut is None:
                last, place, least = _first_digits(scores[:, -1]), columns[:, -1], _first_digits(floor)
                kept = (last > least) | ((last == least) & (place < until))
                bar, upto = np.where(kept, scores[:, -1], floor), np.where(kept, place, until)
                as_good, better = _around(bar)
                cut = np.maximum(as_good, self._reached(fresh, scores, margin)) - margin
                if single:
                    cut = np.nextafter(cut.astype(np.float32), np.float32(-np.inf))
                # nothing can get in where all kept ones are as good as rows can be
                best, full = _first_digits(bar), _first_digits(most)
                cut = np.where((best > full) | ((best == full) & (upto <= self.numbers[at])), cut.dtype.type(np.inf), cut)
            hit = np.flatnonzero(fresh >= cut[:, None])
            if single and len(hit) * MANY_HITS > fresh.size:
                # many scores may tie, which single precision does not tell from better ones
                fresh = rows @ self.exact(at, end).T
                sure = most * terms * 2.0**-51 + 1e-300
                low = np.maximum(as_good, self._reached(fresh, scores, sure)) - sure
                hit = np.flatnonzero((fresh >= low[:, None]) & (cut < np.inf)[:, None])
                row = hit // (end - at)
                hit = hit[(self.numbers[at:end][hit % (end - at)] < upto[row]) | (fresh.reshape(-1)[hit] >= (better - sure)[row])]
            chunk, at = at, end
            if not len(hit):
                continue
            row, column = np.divmod(hit, end - chunk)
            column += chunk
            pending.append((row, self.numbers[column], self.products(rows, row, column)))
            if not chunk or sum(len(p[0]) for p in pending) >= scores.size:
                scores, columns = _improve(scores, columns, *map(np.concatenate, zip(*pending)))
                pending, cut = [], None
        if pending:
            scores, columns = _improve(scores, columns, *map(np.concatenate, zip(*pending)))
        return scores, columns

    @staticmethod
    def _reached(fresh: np.ndarray, scores: np.ndarray, margin: np.ndarray) -> np.ndarray:
        """For rows without enough kept ones, what that many of the fresh scores reach."""
        wanted = scores.shape[1]
        if not np.isneginf(scores[:, -1]).any() or fresh.shape[1] <= wanted:
            return np.full(len(scores), -np.inf)
        own = np.partition(fresh, -wanted, axis=1)[:, -wanted].astype(float)
        return own - np.abs(own) * 10.0 ** (1 - SCORE_DIGITS) - margin


class _Best:
    """The best rows of the right side for each left row, while blocks of it are met one after the other."""

    def __init__(self, left: pd.DataFrame, right: pd.DataFrame, k: int, other_only: bool):
        self.other_only = other_only
        self.right = right.sort_values("id", ignore_index=True)
        self.ids, self.own = self.right["id"].to_numpy(), left["id"].to_numpy()
        self.b = _Vectors(self.right)
        self.a = _Vectors(left, None if self.b.dense is not None else self.b.names)
        floor = left["floor"].to_numpy(dtype=float) if "floor" in left.columns else np.full(len(self.own), np.nan)
        self.floor = np.where(np.isfinite(floor), floor, -np.inf)
        self.until = np.full(len(self.own), len(self.ids))
        if "floor_id" in left.columns:
            known = left["floor_id"].notna().to_numpy()
            # nulls make whole numbers doubles
            after = left["floor_id"].to_numpy()[known].astype(self.ids.dtype)
            self.until[known] = np.searchsorted(self.ids, after)
        # a row may meet itself, one more is then needed
        wanted = min(k + 1 if other_only else k, len(self.ids))
        # places that no right row has taken yet
        self.scores = np.full((len(self.own), wanted), -np.inf)
        self.columns = np.full((len(self.own), wanted), len(self.ids))

    def meet(self, rows: np.ndarray, numbers: np.ndarray) -> None:
        """Let some left rows meet some right rows, both as numbers in order."""
        a, b = self.a.take(rows), self.b.take(numbers)
        present = None if b.dense is not None else np.unique(a.codes[a.codes >= 0])
        at = 0
        while at < len(numbers):
            end, used = _chunk(b, at, len(numbers), len(numbers), present)
            panel = _Panel(b, at, end, used, numbers[at:end])
            step = max(1, min(LEFT_ROWS, DENSE_BYTES // (8 * max(1, panel.width))))
            for start in range(0, len(rows), step):
                stop = min(start + step, len(rows))
                i = rows[start:stop]
                self.scores[i], self.columns[i] = panel.best(
                    a.rows(start, stop, used), self.floor[i], self.until[i], self.scores[i], self.columns[i]
                )
            at = end

    def found(self) -> pd.DataFrame:
        taken = (self.columns < len(self.ids)).ravel()
        out = pd.DataFrame(
            {
                "left_id": np.repeat(self.own, self.scores.shape[1])[taken],
                "right_id": self.ids[self.columns.ravel()[taken]],
                "score": self.scores.ravel()[taken],
            }
        )
        return out[out["left_id"] != out["right_id"]] if self.other_only else out


def _match_blocks(left: pd.DataFrame, right: pd.DataFrame, k: int, other_only: bool) -> pd.DataFrame:
    """The best ``k`` right rows for each left row of two blocks; those below a left row's ``floor`` may be left out."""
    if left.empty or right.empty:
        return pd.DataFrame({"left_id": [], "right_id": [], "score": []})
    best = _Best(left, right, k, other_only)
    best.meet(np.arange(len(left)), np.arange(len(right)))
    return best.found()


def _chunk(
    rows: _Vectors, at: int, most: int, total: int, present: np.ndarray | None
) -> tuple[int, np.ndarray | None]:
    """The end of the next rows to multiply, and their features that the left side has too."""
    end = min(at + most, total)
    while True:
        used = rows.features(at, end)
        if used is None:
            return end, None
        used = np.intersect1d(used, present, assume_unique=True)
        if end - at == 1 or (end - at) * len(used) * 8 <= DENSE_BYTES:
            return end, used
        end = at + (end - at) // 2


def _n_blocks(rows: int) -> int:
    """Blocks of the right side: small enough to be told apart, few enough that their bounds fit in a task."""
    fine = -(-rows // MIN_BLOCK_ROWS)
    return max(1, -(-rows // MAX_BLOCK_ROWS), min(fine, FINE_BLOCKS))


def _blocked(right: DataFrame, blocks: int) -> DataFrame:
    """The rows with their block ``rb``, like rows together.

    Sparse rows are sorted by their first features, as their owner orders them, dense ones by their
    largest component and its sign.
    """
    if "vec" in right.columns:
        sizes = F.transform("vec", lambda x: F.abs(x))
        largest = F.coalesce(F.array_position(sizes, F.array_max(sizes)), F.lit(0)).cast("int")
        order = [largest, F.signum(F.get("vec", largest - 1)), F.array_max(sizes)]
    else:
        order = [F.get("dims", i) for i in range(3)]
    return right.repartitionByRange(blocks, *order, "id").withColumn("rb", F.spark_partition_id())


def _parts(block: pd.DataFrame) -> np.ndarray:
    """The part of each feature of all rows."""
    return np.minimum(np.concatenate([np.asarray(x, dtype=np.int64) for x in block["parts"]]), PARTS - 1)


def _summary(block: pd.DataFrame) -> pd.DataFrame:
    """What bounds the products with the rows of a block.

    The features that most rows have, with their largest and smallest value, and for each part the largest
    length of a row, and of what it has besides.
    """
    if "vec" in block.columns:
        dense = np.stack(block["vec"].to_numpy())
        names, high, low = np.arange(dense.shape[1]), dense.max(axis=0), dense.min(axis=0)
        kinds, rest, norm = names * 0, np.zeros(PARTS), float(np.sqrt((dense * dense).sum(axis=1)).max())
        whole = np.full(PARTS, norm)
    else:
        ends = np.concatenate([[0], np.cumsum(block["dims"].map(len).to_numpy())])
        flat = np.concatenate([np.asarray(x, dtype=np.int64) for x in block["dims"]])
        values = np.concatenate([np.asarray(x, dtype=float) for x in block["vals"]])
        row = np.repeat(np.arange(len(block)), np.diff(ends))
        codes, own = pd.factorize(flat)
        counts = np.bincount(codes, minlength=len(own))
        common = np.sort(np.argsort(-counts, kind="stable")[:COMMON])
        place = np.full(len(own), -1)
        place[common] = np.arange(len(common))
        at = place[codes] if len(codes) else codes
        high, low = np.zeros(len(common)), np.zeros(len(common))
        np.maximum.at(high, at[at >= 0], values[at >= 0])
        np.minimum.at(low, at[at >= 0], values[at >= 0])
        part = _parts(block)
        lengths = lambda some: np.sqrt(np.bincount(row[some], values[some] ** 2, minlength=len(block)).max())
        rest = np.array([lengths((at < 0) & (part == p)) for p in range(PARTS)])
        whole = np.array([lengths(part == p) for p in range(PARTS)])
        norm = float(lengths(at >= -1))
        kinds = np.zeros(len(own), dtype=np.int64)
        kinds[codes] = part
        names, kinds = own[common], kinds[common]
    return pd.DataFrame(
        {
            "rb": [int(block["rb"].iloc[0])],
            "rows": [len(block)],
            "names": [np.asarray(names, dtype=np.int64)],
            "kinds": [np.asarray(kinds, dtype=np.int64)],
            "high": [high],
            "low": [low],
            "rest": [rest],
            "whole": [whole],
            "norm": [norm],
        }
    )


def _bounds(rows: pd.DataFrame, blocks: list[dict]) -> np.ndarray:
    """For each row and block, no less than the largest product of the row with a row of the block."""
    if "vec" in rows.columns:
        dense = np.stack(rows["vec"].to_numpy())
        high, low = (np.stack([b[c] for b in blocks]) for c in ("high", "low"))
        norm = np.sqrt((dense * dense).sum(axis=1))
        bound = np.maximum(dense, 0) @ high.T + np.minimum(dense, 0) @ low.T
    else:
        known = pd.Index(np.unique(np.concatenate([b["names"] for b in blocks])))
        vectors = _Vectors(rows, known)
        place = np.repeat(np.arange(len(rows)), np.diff(vectors.ends)) * PARTS + _parts(rows)
        square = np.bincount(place, vectors.values**2, minlength=len(rows) * PARTS).reshape(-1, PARTS)
        norm = np.sqrt(square.sum(axis=1))
        bound = np.empty((len(rows), len(blocks)))
        codes = [known.get_indexer(pd.Index(b["names"])) for b in blocks]
        step = max(1, DENSE_BYTES // (8 * max(1, len(known))))
        for start in range(0, len(rows), step):
            some = slice(start, min(start + step, len(rows)))
            dense = vectors.rows(some.start, some.stop, np.arange(len(known)))
            for i, b in enumerate(blocks):
                met = dense[:, codes[i]]
                of_part = np.eye(PARTS)[b["kinds"]]
                left = np.sqrt(np.maximum(square[some] - (met * met) @ of_part, 0.0))
                best = np.maximum(met, 0) * b["high"] + np.minimum(met, 0) * b["low"]
                known_part = best @ of_part + left * b["rest"]
                bound[some, i] = np.minimum(known_part, np.sqrt(square[some]) * b["whole"]).sum(axis=1)
    # no more than the product of the lengths, and rounding must not hide a tie
    lengths = norm[:, None] * np.array([b["norm"] for b in blocks])[None, :]
    return np.minimum(bound, lengths) + BOUND_SLACK * lengths


def _plain(rows: pd.DataFrame) -> pd.DataFrame:
    """Ids of types that pandas keeps in pieces as objects, which Spark takes back."""
    odd = [c for c in ("id", "left_id", "right_id", "floor_id") if c in rows.columns and not isinstance(rows[c].dtype, np.dtype)]
    return rows.astype(dict.fromkeys(odd, object)) if odd else rows


def _asked(blocks: list[dict], k: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Adds the blocks that each row must meet.

    Without a floor that is the one block with the largest bound among those of ``k`` rows, where the row
    finds its floor. With it, all others whose bound reaches the floor.
    """
    numbers = np.array([b["rb"] for b in blocks])
    enough = np.array([b["rows"] >= k for b in blocks])
    enough = enough if enough.any() else np.ones(len(blocks), bool)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), LEFT_ROWS):
                rows = frame.iloc[start : start + LEFT_ROWS].reset_index(drop=True)
                bound = _bounds(rows, blocks)
                first = np.where(enough[None, :], bound, -np.inf).argmax(axis=1)
                if "floor" in rows.columns:
                    floor = rows["floor"].to_numpy(dtype=float)
                    floor = np.where(np.isnan(floor), -np.inf, floor)
                    wide = np.where(np.isfinite(floor), np.abs(floor) * BOUND_SLACK, 0.0)
                    needed = bound >= (floor - wide)[:, None]
                    needed[np.arange(len(rows)), first] = False
                    asked = [numbers[n].tolist() for n in needed]
                else:
                    asked = [[int(numbers[f])] for f in first]
                yield _plain(rows.assign(blocks=asked))

    return run


class Matching:
    """The two sides of one matching: rows of the left, blocks of the right and their bounds."""

    def __init__(self, left: DataFrame, right: DataFrame, k: int, exclude_same_id: bool, left_rows: int, right_rows: int):
        self.k, self.exclude = k, exclude_same_id
        # a row may meet itself, one more is then needed
        self.wanted = k + 1 if exclude_same_id else k
        # features travel as numbers, by the hash of their names
        numbers = F.transform("dims", lambda d: F.xxhash64(d)).alias("dims")
        part = "parts" if "parts" in right.columns else F.transform("dims", lambda d: F.lit(0)).alias("parts")
        columns = ["id", "vec"] if "vec" in right.columns else ["id", numbers, "vals", part]
        cores = left.sparkSession.sparkContext.defaultParallelism
        every = materialize(left.select(*columns), "left-rows")
        zero = F.forall("vec" if "vec" in right.columns else "vals", lambda x: x == 0)
        # rows of zeros score nothing with all others
        self.left, self.zeros = every.where(~zero), every.where(zero)
        self.right = materialize(_blocked(right.select(*columns), _n_blocks(right_rows)), "right-blocks")
        spread = max(1, int(np.ceil(np.sqrt(4 * cores))))
        self.cores, self.rows = cores, left_rows + right_rows
        arrays = "names array<long>, kinds array<long>, high array<double>, low array<double>"
        summary = f"rb int, rows long, {arrays}, rest array<double>, whole array<double>, norm double"
        kinds = {"names": np.int64, "kinds": np.int64} | dict.fromkeys(("high", "low", "rest", "whole"), float)
        self.blocks = [
            row.asDict() | {c: np.asarray(row[c], dtype=kind) for c, kind in kinds.items()}
            for row in self.right.groupBy("rb").applyInPandas(_summary, summary).collect()
        ]
        # neighbouring blocks share a task, to which a left row is sent once
        last = max((b["rb"] for b in self.blocks), default=0) + 1
        # and so many of them that these have no more rows than a task holds
        self.per_group = max(1, last // max(1, -(-right_rows // MAX_BLOCK_ROWS), min(last, spread)))
        self.sizes = np.zeros(-(-last // self.per_group), np.int64)
        for b in self.blocks:
            self.sizes[b["rb"] // self.per_group] += b["rows"]

    def group(self, block: Column) -> Column:
        return F.floor(block / self.per_group).cast("int")

    def rounds(self, asked: DataFrame) -> list[dict[int, int]]:
        """In how many parts the left rows that meet a group of blocks are cut, so that a task has a bounded number of them.

        Each part needs a copy of the group. Groups are met in rounds, one after the other, whose copies and left rows are
        no more than ``COPIES`` times the rows of both sides, so what is shuffled at a time does not grow with their product.
        """
        groups = F.explode(F.array_distinct(F.transform("blocks", self.group))).alias("rg")
        meet = {r["rg"]: r["n"] for r in asked.select(groups).groupBy("rg").agg(F.count("*").alias("n")).collect()}
        each = -(-4 * self.cores // max(1, len(meet)))
        out, moved = [], 0
        for g, n in sorted(meet.items()):
            cut = max(-(-n // MAX_BLOCK_ROWS), min(-(-n // MIN_BLOCK_ROWS), each))
            moving = int(self.sizes[g]) * cut + n
            if not out or moved + moving > COPIES * self.rows:
                out.append({})
                moved = 0
            out[-1][g] = cut
            moved += moving
        return out

    def asked(self, floors: DataFrame | None = None) -> DataFrame:
        """The left rows with the blocks that they must meet."""
        rows = self.left if floors is None else lookup(self.left, floors, ["id"], "left")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInPandas(_asked(self.blocks, self.wanted), f"{kinds}, blocks array<int>")

    def scored(self, asked: DataFrame, parts: dict[int, int] | None = None) -> DataFrame:
        """(left_id, right_id, score): the best ``k`` of each block for the rows that meet it, in the groups of a round or all."""
        if parts is None:
            parts = {g: cut for some in self.rounds(asked) for g, cut in some.items()}
        most = max(parts, default=-1) + 1
        cuts = F.array(*[F.lit(parts.get(g, 0)) for g in range(most)]).cast("array<int>")
        before = np.concatenate([[0], np.cumsum([parts.get(g, 0) for g in range(most)])]).tolist()
        starts = F.array(*[F.lit(x) for x in before]).cast("array<int>")
        own = F.get(cuts, F.col("rg"))
        here = (F.col("rg") < most) & (own > 0)
        lefts = asked.select("*", F.explode(F.array_distinct(F.transform("blocks", self.group))).alias("rg")).where(here)
        lefts = lefts.withColumn("blocks", F.filter("blocks", lambda b: self.group(b) == F.col("rg")))
        lefts = lefts.withColumn("part", F.pmod(F.xxhash64("id"), own).cast("int"))
        rights = self.right.select("*", self.group(F.col("rb")).alias("rg")).where(here)
        rights = rights.withColumn("part", F.explode(F.sequence(F.lit(0), own - 1)))
        tasks = max(1, min(before[-1], MAX_TASKS))
        task = F.pmod(F.get(starts, F.col("rg")) + F.col("part"), F.lit(tasks)).cast("int")

        def placed(side: DataFrame) -> GroupedData:
            return side.withColumn("task", task).repartitionById(tasks, "task").groupBy("task", "rg", "part")

        k, exclude = self.k, self.exclude

        def match(left_rows: pd.DataFrame, right_rows: pd.DataFrame) -> pd.DataFrame:
            if left_rows.empty or right_rows.empty:
                # without rows a frame must have no columns either, whose types Spark would not take back
                return pd.DataFrame()
            best = _Best(left_rows, right_rows, k, exclude)
            sizes = left_rows["blocks"].map(len).to_numpy()
            row, met = np.repeat(np.arange(len(left_rows)), sizes), np.concatenate(left_rows["blocks"].to_numpy())
            block = best.right["rb"].to_numpy()
            blocks = np.unique(block)
            # where most rows meet most blocks, these are met as one
            together = 2 * sizes.mean() > len(blocks)
            if together:
                best.meet(np.arange(len(left_rows)), np.arange(len(block)))
            else:
                for b in blocks:
                    some = row[met == b]
                    if len(some):
                        best.meet(some, np.flatnonzero(block == b))
            found = best.found()
            if together and len(found):
                asked = left_rows.set_index("id")["blocks"].map(set)
                own = found["right_id"].map(pd.Series(block, best.ids))
                found = found[[b in s for b, s in zip(own, found["left_id"].map(asked))]]
            if "floor" in left_rows.columns and len(found):
                floor = found["left_id"].map(left_rows.set_index("id")["floor"]).to_numpy(dtype=float)
                score = found["score"].to_numpy()
                found = found[np.isnan(floor) | (score >= floor - np.abs(floor) * BOUND_SLACK)]
            return _plain(found) if len(found) else pd.DataFrame()

        types = [df.schema["id"].dataType.simpleString() for df in (self.left, self.right)]
        return placed(lefts).cogroup(placed(rights)).applyInPandas(
            match, f"left_id {types[0]}, right_id {types[1]}, score double"
        )

    def unscored(self) -> DataFrame:
        """(left_id, right_id, score): the smallest right ids for the rows of zeros."""
        least = [F.lit(row[0]) for row in self.right.select("id").orderBy("id").limit(self.wanted).collect()]
        met = self.zeros.select(F.col("id").alias("left_id"), F.explode(F.array(*least)).alias("right_id"))
        met = met.withColumn("score", F.lit(0.0))
        return met.where(F.col("left_id") != F.col("right_id")) if self.exclude else met

    def floors(self, first: DataFrame) -> DataFrame:
        """(id, floor, floor_id): the score and the right id of the ``k``-th of the rows found first."""
        entry = F.struct(-comparable(F.col("score")), "right_id", "score")
        found = first.groupBy(F.col("left_id").alias("id")).agg(F.sort_array(F.collect_list(entry)).alias("found"))
        kth = F.get("found", self.k - 1)
        return found.select("id", kth["score"].alias("floor"), kth["right_id"].alias("floor_id"))


def packed_cells(cells: DataFrame) -> DataFrame:
    """(id, dims, vals) for ``best_matches`` from (id, dim, x), the largest first; cells of one place count together."""
    summed = cells.groupBy("id", "dim").agg(F.sum("x").alias("x"))
    packed = summed.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("x", "dim")), False).alias("cells"))
    return packed.select(
        "id", F.transform("cells", lambda c: c["dim"]).alias("dims"), F.transform("cells", lambda c: c["x"]).alias("vals")
    )


def cheaper(met: int, left_rows: int, right_rows: int, columns: int) -> bool:
    """Whether products of blocks cost less than to join ``met`` rows of the two sides and score the pairs found."""
    return met * MET_COST > left_rows * right_rows * (1 + columns / COLUMNS_COST)


def best_matches(
    left: DataFrame,
    right: DataFrame,
    k: int,
    exclude_same_id: bool = False,
    left_rows: int | None = None,
    right_rows: int | None = None,
) -> DataFrame:
    """(left_id, pos, right_id, score): the ``k`` right rows with the largest dot product.

    Each side has a unique ``id`` and either ``vec``, an array of equal length everywhere, or
    ``dims`` and ``vals``, the names and values of the non-zero features. ``parts`` may number the kind of each
    feature, the same on both sides: lengths of features that cannot meet then do not widen a bound. ``left_rows``
    and ``right_rows`` spare the counts that size the blocks.
    """
    left_rows = left.count() if left_rows is None else left_rows
    right_rows = right.count() if right_rows is None else right_rows
    met = Matching(left, right, k, exclude_same_id, left_rows, right_rows)
    if not met.blocks:
        types = [df.schema["id"].dataType.simpleString() for df in (left, right)]
        schema = f"left_id {types[0]}, pos int, right_id {types[1]}, score double"
        return left.sparkSession.createDataFrame([], schema)
    asked, path = materialize_at(met.asked(), "asked")
    # a row meets one block here, so no more than k rows are found for it
    first = [materialize(met.scored(asked, parts), "first-matches") for parts in met.rounds(asked)]
    drop_paths(left.sparkSession, [path])
    found = reduce(DataFrame.union, first, met.unscored())
    asked = materialize(met.asked(met.floors(found)), "asked")
    written = []
    for number, parts in enumerate(rounds := met.rounds(asked)):
        # what was found in the rounds before lifts the floors
        rows = lookup(asked.drop("floor", "floor_id"), met.floors(found), ["id"], "left") if number else asked
        found = found.union(met.scored(rows, parts))
        if number + 1 < len(rounds):
            best = top_list_rows(found, "left_id", "right_id", "score", k)
            found, path = materialize_at(best.select("left_id", "right_id", "score"), "matches")
            drop_paths(left.sparkSession, written)
            written = [path]
    return top_list_rows(found, "left_id", "right_id", "score", k)


def nearest(vectors: DataFrame, id_col: str, vec_col: str, k: int, **sizes) -> DataFrame:
    """(id, pos, neighbour_id, sim): the ``k`` nearest other rows by cosine; zero vectors and those with
    a NaN or an infinite value have none and are nobody's neighbour."""
    squares = F.transform(vec_col, lambda x: x.cast("double") * x.cast("double"))
    norm = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
    unit = (
        vectors.select(F.col(id_col).alias("id"), F.col(vec_col), norm.alias("_norm"))
        # NaN compares as larger than any number
        .where((F.col("_norm") > 0) & ~F.isnan("_norm") & (F.col("_norm") < float("inf")))
        .select("id", F.transform(vec_col, lambda x: x.cast("double") / F.col("_norm")).alias("vec"))
    )
    # counted and read as both sides
    unit = materialize(unit, "unit-vectors")
    found = best_matches(unit, unit, k, exclude_same_id=True, **sizes)
    return as_neighbours(found)


def as_neighbours(found: DataFrame) -> DataFrame:
    """The columns of ``best_matches`` within one set, named (id, pos, neighbour_id, sim)."""
    return found.select(
        F.col("left_id").alias("id"),
        "pos",
        F.col("right_id").alias("neighbour_id"),
        F.col("score").alias("sim"),
    )
