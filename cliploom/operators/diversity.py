"""Diverse assignment of catalogue entries to jobs.

Every job has to look at every free candidate, so both sides are cut into blocks of
bounded size and each pair of blocks is one task group. A group returns at most the best
candidates of each of its jobs; pairs are never turned into rows. Numpy does the distance
arithmetic inside the group, on blocks that travel as one row each.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliploom.functions.digests import sha1_heads
from cliploom.operators.kernels import GROUP_ROWS, largest_group, number_rows
from cliploom.session import pin, scratch_path

BLOCK = 2048           # subjects in one row, where candidates are hashed
NAMES = 16384          # candidates in one row, there
WINDOW_ROWS = 4_000_000  # hashes near the wanted ranks of a row of subjects, about
SIGMAS = 5.0           # deviations of a rank that its window reaches to either side
PACKED = 8192          # jobs in one row
TILE = 4096            # candidates that meet the vectors of a block at a time
VECTORS = 4096         # vectors of jobs that meet a tile at a time
HISTORY_PART = 256     # earlier vectors of a subject in one row
PREFERENCES = 64       # choices fetched at once; results do not depend on it
LISTED = 2**25         # numbers in the lists of several rounds, vectors of candidates included
LEAST_LISTED = 64      # candidates of a subject below which nothing is listed
AHEAD_ROWS = 500_000   # jobs that meet their lists at once
_PICK = "id long, preset_id string, distance double, tie string"
_LIST = "subjects array<string>, names array<string>, vectors binary, width long, owner binary, place binary, distance binary, bounds binary"
_LIST_COLUMNS = [field.split()[0] for field in _LIST.split(", ")]
_ROUND = "id long, subject_id string, preset_id string, round int"
_WINDOW = "_lb long, _rb long, subjects array<string>, below binary, owner binary, place binary, tie binary"
_WINDOW_COLUMNS = [field.split()[0] for field in _WINDOW.split(", ")]


def _tie(subject: str, job: object, preset: str) -> str:
    text = f"{subject}:{preset}" if job is None else f"{subject}:{job}:{preset}"
    return hashlib.sha1(text.encode("utf-8")).hexdigest()[:16]


def _block_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(n))


def _all_of(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def nearest_sq(candidates: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Squared distance of each candidate to its nearest history vector."""
    out = np.full(len(candidates), np.inf)
    step = max(1, 4_000_000 // max(1, candidates.size))
    for i in range(0, len(history), step):
        part = history[i:i + step]
        out = np.minimum(out, ((candidates[:, None, :] - part[None, :, :]) ** 2).sum(axis=2).min(axis=1))
    return out


def _flat(vectors: list) -> tuple[bytes, int]:
    matrix = np.array(vectors, dtype=float).reshape(len(vectors), -1) if vectors else np.empty((0, 0))
    return matrix.tobytes(), matrix.shape[1]


def _pack_jobs(keys: tuple, jobs: pd.DataFrame) -> pd.DataFrame:
    """A block of jobs as one row: each distinct vector once, and for each job the places of its own."""
    place, distinct, rows = {}, [], []
    for (job, subject), own in jobs.groupby(["id", "subject_id"], sort=False):
        mine = []
        for vector in (v for vectors in own["vectors"] for v in vectors):
            key = np.asarray(vector, dtype=float).tobytes()
            if key not in place:
                place[key] = len(distinct)
                distinct.append(vector)
            mine.append(place[key])
        rows.append((int(job), subject, np.array(mine, dtype=np.int64).tobytes()))
    packed = [(keys[0], *(list(x) for x in zip(*rows)), *_flat(distinct))] if rows else []
    return pd.DataFrame(packed, columns=["_lb", "ids", "subjects", "places", "vectors", "width"])


def _pack_catalog(keys: tuple, catalog: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame([(keys[0], catalog["preset_id"].tolist(), *_flat(catalog["vector"].tolist()))], columns=["_rb", "names", "vectors", "width"])


def farthest(catalog: np.ndarray, vectors: np.ndarray, places: list[np.ndarray], top: int) -> list[np.ndarray]:
    """For each job the rows of ``catalog`` that may be among the ``top`` farthest from their nearest of the job's vectors.

    A tile of candidates meets each distinct vector once, however many jobs have it; a job then
    takes the least of its own rows. That is done in single precision, so a row stays as long as
    it is not behind the ``top`` best by more than rounding can explain.
    """
    scale = float((catalog**2).sum(axis=1).max() + (vectors**2).sum(axis=1).max(initial=0.0))
    kind = np.float32 if 1e-20 < scale < 1e30 else np.float64
    slack = 8 * (catalog.shape[1] + 4) * float(np.finfo(kind).eps) * scale
    bars, kept = np.full(len(places), -np.inf), [[] for _ in places]
    chunks, size = [[]], 0
    for j, mine in enumerate(places):
        if size and size + len(mine) > VECTORS < len(vectors):
            chunks.append([])
            size = 0
        chunks[-1].append(j)
        size += len(mine)
    for chunk in chunks:
        used = np.unique(np.concatenate([places[j] for j in chunk]))
        some = vectors[used]
        at = [np.searchsorted(used, places[j]) for j in chunk]
        flat, norms = (-2.0 * some).astype(kind), (some**2).sum(axis=1).astype(kind)[:, None]
        for start in range(0, len(catalog), TILE):
            part = catalog[start : start + TILE]
            table = flat @ part.astype(kind).T
            table += norms
            table += (part**2).sum(axis=1).astype(kind)
            for j, mine in zip(chunk, at):
                near = table[mine].min(axis=0, initial=np.inf)
                best = near.max() if top == 1 else np.partition(near, len(near) - top)[len(near) - top] if top <= len(near) else -np.inf
                bars[j] = max(bars[j], best)
                rows = np.flatnonzero(near >= bars[j] - slack)
                if len(rows):
                    kept[j].append((start + rows, near[rows]))
    out = []
    for bar, found in zip(bars, kept):
        rows, near = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, dtype=int), np.empty(0))
        if len(near) > top:
            bar = max(bar, np.partition(near, len(near) - top)[len(near) - top])
        out.append(rows[near >= bar - slack])
    return out


def _best_of_block(top: int):
    def best(_, jobs: pd.DataFrame, catalog: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(jobs) and len(catalog):
            own, other = jobs.iloc[0], catalog.iloc[0]
            matrix = np.frombuffer(other["vectors"]).reshape(-1, other["width"])
            vectors = np.frombuffer(own["vectors"]).reshape(-1, own["width"] or other["width"])
            names, places = other["names"], [np.frombuffer(x, dtype=np.int64) for x in own["places"]]
            for job, subject, mine, keep in zip(own["ids"], own["subjects"], places, farthest(matrix, vectors, places, top)):
                exact = nearest_sq(matrix[keep], vectors[mine])
                if len(keep) > top:  # hashes only of what may be among the best
                    some = exact >= np.partition(exact, len(exact) - top)[len(exact) - top]
                    keep, exact = keep[some], exact[some]
                ties = [_tie(subject, job, names[i]) for i in keep]
                order = sorted(range(len(keep)), key=lambda i: (-exact[i], ties[i]))[:top]
                rows.extend((job, names[keep[i]], float(exact[i]), ties[i]) for i in order)
        return pd.DataFrame(rows, columns=["id", "preset_id", "distance", "tie"])

    return best


def _history_parts(history: DataFrame, size: int, longest: int | None = None) -> DataFrame:
    """Earlier vectors per subject, in lists of about ``size``.

    A plan gives a subject at most twelve actions, so one part is the rule; a subject with
    far more has several rows, cut by vector hash, which meet again in each block. ``longest``
    is the largest number of vectors of a subject, where that is known.
    """
    if longest is not None and longest <= size:
        return history.groupBy("subject_id").agg(F.collect_set("vector").alias("vectors"))
    distinct = history.select("subject_id", "vector").distinct()
    parts = distinct.groupBy("subject_id").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).alias("parts"))
    return (
        distinct.join(parts, "subject_id")
        .withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")))
        .groupBy("subject_id", "part", "parts")
        .agg(F.collect_list("vector").alias("vectors"))
    )


def _block_pairs(jobs: DataFrame, catalog: DataFrame, history: DataFrame, block: int, history_part: int, sizes: tuple[int, int, int] | None, longest: int | None):
    """Each block of jobs beside each block of the catalogue, and how many blocks the catalogue has; see ``preferences``."""
    side = jobs.select("id", "subject_id").join(_history_parts(history, history_part, longest), "subject_id")
    n_side, n_vectors, n_catalog = sizes or (*side.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("vectors")), F.lit(0))).first(), catalog.count())
    width = int(jobs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lefts = max(1, math.ceil(n_side / block), math.ceil(n_vectors / (8 * block)))
    rights = max(1, math.ceil(n_catalog / (8 * block)), min(math.ceil(n_catalog / TILE), math.ceil(width / lefts)))
    lefts = max(lefts, min(n_side, math.ceil(width / rights)))  # a group for every core
    left = side.withColumn("_lb", _block_of("id", lefts)).groupBy("_lb").applyInPandas(_pack_jobs, "_lb long, ids array<long>, subjects array<string>, places array<binary>, vectors binary, width long")
    right = catalog.select("preset_id", "vector", _block_of("preset_id", rights).alias("_rb")).groupBy("_rb").applyInPandas(_pack_catalog, "_rb long, names array<string>, vectors binary, width long")
    pairs = [left.withColumn("_rb", _all_of(rights)), right.withColumn("_lb", _all_of(lefts))]
    return pairs[0].groupBy("_lb", "_rb").cogroup(pairs[1].groupBy("_lb", "_rb")), rights


def preferences(jobs: DataFrame, catalog: DataFrame, history: DataFrame, top: int = 1,
                block: int = PACKED, history_part: int = HISTORY_PART, sizes: tuple[int, int, int] | None = None, longest: int | None = None) -> DataFrame:
    """The ``top`` most distant candidates of each job whose subject has a history.

    ``jobs`` (id, subject_id), ``catalog`` (preset_id, vector) of free candidates and
    ``history`` (subject_id, vector). A candidate's distance is the squared distance to
    the subject's nearest earlier vector; equal distances go to the smaller stable hash of
    subject:job:candidate. ``sizes`` are the rows of jobs with parts of their history, the
    vectors in them and the rows of the catalogue, at most, where they are known; else they are
    counted. ``longest`` is the largest number of vectors of a subject, where that is known.

    A block of either side is packed into one row before it is repeated for the blocks of the
    other; a block of jobs holds ``block`` of them and eight times as many vectors, a block of
    the catalogue eight times ``block``.
    """
    both, rights = _block_pairs(jobs, catalog, history, block, history_part, sizes, longest)
    both = both.applyInPandas(_best_of_block(top), _PICK)
    ordered = F.struct((-F.col("distance")).alias("far"), "tie", "preset_id")
    if top == 1:
        best = both.groupBy("id").agg(F.min(ordered).alias("_b"))
        return best.select("id", F.lit(1).cast("long").alias("choice"), F.col("_b.preset_id").alias("preset_id"), (-F.col("_b.far")).alias("distance"))
    both, order = both.withColumn("far", -F.col("distance")), ["far", "tie", "preset_id"]
    if top * rights <= GROUP_ROWS:  # a job has no more rows than that
        ranked = both.withColumn("choice", F.row_number().over(Window.partitionBy("id").orderBy(*order)).cast("long"))
    else:
        ranked = number_rows(both, ["id"], order, "choice")
    return ranked.filter(F.col("choice") <= top).select("id", "choice", "preset_id", "distance")


def pick_diverse(jobs: DataFrame, catalog: DataFrame, history: DataFrame, block: int = PACKED,
                 history_part: int = HISTORY_PART) -> DataFrame:
    """Most distant free candidate per job; jobs of subjects without history are left out."""
    return preferences(jobs, catalog, history, 1, block, history_part).drop("choice")


def _hashes_in_window(low: int, high: int):
    """One row for a block of subjects and one of candidates: per subject how many hash below the window, and the hashes inside it.

    ``low`` and ``high`` are the first and last leading 32 bits of the window.
    """
    def count(_, subjects: pd.DataFrame, catalog: pd.DataFrame) -> pd.DataFrame:
        if not len(subjects) or not len(catalog):
            return pd.DataFrame(columns=_WINDOW_COLUMNS)
        own, other = subjects.iloc[0], catalog.iloc[0]
        below, found = np.zeros(len(own["subjects"]), dtype=np.int64), []
        for rows, cols, first, second in sha1_heads([f"{s}:".encode("utf-8") for s in own["subjects"]], [n.encode("utf-8") for n in other["names"]]):
            below[rows] += (first < np.uint32(low)).sum(axis=1)
            i, j = np.nonzero(first - np.uint32(low) <= np.uint32(high - low))
            found.append((rows[i].astype(np.int32), cols[j].astype(np.int32), first[i, j].astype(np.uint64) << np.uint64(32) | second[i, j]))
        owner, place, tie = (np.concatenate(x).tobytes() for x in zip(*found))
        return pd.DataFrame([(own["_lb"], other["_rb"], own["subjects"], below.tobytes(), owner, place, tie)], columns=_WINDOW_COLUMNS)

    return count


def _choose(rank: int, need: int, whole: bool):
    """The candidates of a block of subjects from ``rank`` on; a subject whose window does not hold them all has no row."""
    def choose(_: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        subjects = parts["subjects"].iloc[0]
        start = rank - sum(np.frombuffer(x, dtype=np.int64) for x in parts["below"])
        owner, place = (np.concatenate([np.frombuffer(x, dtype=np.int32) for x in parts[c]]) for c in ("owner", "place"))
        tie = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in parts["tie"]])
        block = np.repeat(parts["_rb"].to_numpy(), [len(x) // 4 for x in parts["owner"]])
        order = np.lexsort((place, block, tie, owner))
        ends = np.searchsorted(owner[order], np.arange(len(subjects)), side="right")
        begins = np.concatenate([[0], ends[:-1]])
        rows = []
        for i in np.flatnonzero((start >= 0) & (whole | (begins + start + need <= ends))):
            picked = order[begins[i] + start[i] : min(ends[i], begins[i] + start[i] + need)]
            rows.extend((subjects[i], at, block[k], place[k]) for at, k in enumerate(picked, 1))
        return pd.DataFrame(rows, columns=["subject_id", "choice", "_rb", "_at"])

    return choose


def _ranked_by_hash(subjects: DataFrame, catalog: DataFrame, n: int, rank: int, spread: float, block: int, need: int) -> DataFrame:
    """Candidates from ``rank`` on of the subjects for which a window of ``spread`` to either side holds them.

    A block of either side is packed into one row, in a fixed order, before it is repeated for the
    blocks of the other. Windows travel as buffers; a block has fewer subjects where they are long.
    """
    middle, space, whole = (rank + 0.5) / n, 2**32, spread >= 0.5
    low = 0 if whole else int(max(0.0, middle - spread) * space)
    high = space - 1 if whole else min(space - 1, int((middle + spread) * space))
    count, width = subjects.count(), int(subjects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = max(1, min(block, int(WINDOW_ROWS / (n * min(1.0, 2 * spread) + 1))))
    rights = max(1, math.ceil(n / NAMES))
    lefts = max(1, math.ceil(count / block), min(count, math.ceil(2 * width / rights)))  # groups for every core
    left = subjects.groupBy(_block_of("subject_id", lefts).alias("_lb")).agg(F.array_sort(F.collect_list("subject_id")).alias("subjects"))
    right = pin(catalog.groupBy(_block_of("preset_id", rights).alias("_rb")).agg(F.array_sort(F.collect_list("preset_id")).alias("names")))
    # a fixed number of partitions, as few bytes are much work here
    sides = [side.repartition(lefts * rights, "_lb", "_rb").groupBy("_lb", "_rb") for side in (left.withColumn("_rb", _all_of(rights)), right.withColumn("_lb", _all_of(lefts)))]
    found = sides[0].cogroup(sides[1]).applyInPandas(_hashes_in_window(low, high), _WINDOW)
    picked = found.groupBy("_lb").applyInPandas(_choose(rank, need, whole), "subject_id string, choice long, _rb long, _at int")
    return picked.join(right.select("_rb", F.posexplode("names").alias("_at", "preset_id")), ["_rb", "_at"]).select("subject_id", "choice", "preset_id")


def cold_preferences(subjects: DataFrame, catalog: DataFrame, top: int = 1, block: int = BLOCK, size: int | None = None) -> DataFrame:
    """Candidates from rank n // 3 on, in the order of the stable hash of subject:candidate.

    Hashes are uniform, so only those near the wanted rank are kept and the rest counted.
    A subject whose ranks fall outside the window is repeated with a wider one.
    """
    catalog = catalog.select("preset_id").filter("preset_id IS NOT NULL")
    n = catalog.count() if size is None else size
    if n == 0:
        raise ValueError("no free candidates left")
    rank, left, picked = n // 3, subjects.select("subject_id").filter("subject_id IS NOT NULL").distinct(), None
    need = min(top, n - rank)
    spread = SIGMAS * math.sqrt(2.0 / 9.0 / n) + 2.0 * (need + 1) / n
    while True:
        some = _ranked_by_hash(left, catalog, n, rank, spread, block, need)
        if spread < 0.5:
            some = pin(some)
        picked = some if picked is None else picked.unionByName(some)
        if spread >= 0.5:
            return picked
        left = pin(left.join(some.select("subject_id").distinct(), "subject_id", "left_anti"))
        if not left.limit(1).count():
            return picked
        spread *= 4


def pick_cold(jobs: DataFrame, catalog: DataFrame, block: int = BLOCK) -> DataFrame:
    """Candidate at rank n // 3 of the hash order, per job."""
    picked = cold_preferences(jobs.select("subject_id"), catalog, 1, block).drop("choice")
    return jobs.select("id", "subject_id").join(picked, "subject_id").select("id", "preset_id")


def _lists_of_block(size: int):
    """For each job of a block its ``size`` farthest candidates of a block, without those as far as the next one, and how far that is."""
    def listed(_, jobs: pd.DataFrame, catalog: pd.DataFrame) -> pd.DataFrame:
        if not len(jobs) or not len(catalog):
            return pd.DataFrame(columns=_LIST_COLUMNS)
        own, other = jobs.iloc[0], catalog.iloc[0]
        matrix = np.frombuffer(other["vectors"]).reshape(-1, other["width"])
        vectors = np.frombuffer(own["vectors"]).reshape(-1, own["width"] or other["width"])
        places = [np.frombuffer(x, dtype=np.int64) for x in own["places"]]
        bounds, found, far = np.full(len(places), -np.inf), [], []
        for i, keep in enumerate(farthest(matrix, vectors, places, size + 1)):
            exact = nearest_sq(matrix[keep], vectors[places[i]])
            if len(keep) > size:
                bounds[i] = np.partition(exact, len(exact) - size - 1)[len(exact) - size - 1]
                keep, exact = keep[exact > bounds[i]], exact[exact > bounds[i]]
            found.append(keep)
            far.append(exact)
        used, place = np.unique(np.concatenate(found), return_inverse=True)
        owner = np.repeat(np.arange(len(found), dtype=np.int32), [len(x) for x in found])
        names = [other["names"][i] for i in used]
        return pd.DataFrame([(own["subjects"], names, matrix[used].tobytes(), other["width"], owner.tobytes(), place.astype(np.int32).tobytes(), np.concatenate(far).tobytes(), bounds.tobytes())], columns=_LIST_COLUMNS)

    return listed


def _gathered(lists: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, dict]:
    """Names and vectors of the candidates in ``lists``, and for each subject their places, distances and what no other candidate exceeds."""
    code, names = pd.factorize(np.concatenate([np.asarray(x, dtype=object) for x in lists["names"]]))
    matrix = np.concatenate([np.frombuffer(v).reshape(-1, w) for v, w in zip(lists["vectors"], lists["width"])])[np.unique(code, return_index=True)[1]]
    parts, start = {}, 0
    for row in lists.itertuples():
        owner, place, far = np.frombuffer(row.owner, np.int32), np.frombuffer(row.place, np.int32), np.frombuffer(row.distance)
        ends = np.searchsorted(owner, np.arange(len(row.subjects) + 1))
        for i, (subject, bound) in enumerate(zip(row.subjects, np.frombuffer(row.bounds))):
            mine = slice(ends[i], ends[i + 1])
            parts.setdefault(subject, []).append((code[start + place[mine]], far[mine], bound))
        start += len(row.names)
    own = {}
    for subject, some in parts.items():
        places, far, bounds = zip(*some)
        places, far, bound = np.concatenate(places), np.concatenate(far), max(bounds)
        own[subject] = places[far > bound], far[far > bound], bound
    return names, matrix, own


def _nth(far: np.ndarray, n: int, tie) -> int:
    """Place of the ``n``-th largest; equal ones in the order of ``tie(place)``."""
    bar = far.max() if n == 1 else np.partition(far, len(far) - n)[len(far) - n]
    same = np.flatnonzero(far == bar)
    return same[0] if len(same) == 1 else sorted(same, key=tie)[n - 1 - np.count_nonzero(far > bar)]


def _rounds_of_lists(turn: int, ahead: int):
    """The picks of rounds from ``turn`` on, ``ahead`` of them at most, as long as the lists decide them.

    A distance only falls as a subject gets vectors, so a listed candidate that is still farther than
    all others were when the lists were made is farther than they are now. The rounds end before one
    in which a job needs a choice that its list no longer has.
    """
    def run(_, lists: pd.DataFrame, queue: pd.DataFrame) -> pd.DataFrame:
        names, matrix, own = _gathered(lists)
        queue = queue.sort_values(["split_rank", "subject_id", "id"], na_position="first", ignore_index=True)
        ids, subjects = queue["id"].tolist(), queue["subject_id"].tolist()
        waiting, taken, picks = {}, np.zeros(len(names), dtype=bool), []
        for at, subject in enumerate(subjects):  # a job is its place in the order of all
            waiting.setdefault(subject, deque()).append(at)

        def choice(job: int, n: int) -> int | None:
            """The ``n``-th choice; None where there are fewer candidates, -1 where others than the listed ones may be it."""
            places, far, bound = own[subjects[job]]
            if n > len(far):
                return None if bound == -np.inf else -1
            return places[_nth(far, n, lambda i: (_tie(subjects[job], ids[job], names[places[i]]), names[places[i]]))]

        for now in range(turn, turn + ahead):
            wants, won = {}, {}
            for subject, jobs in waiting.items():
                if jobs:
                    places, far, bound = own[subject]
                    own[subject] = places[~taken[places]], far[~taken[places]], bound
                    wants.setdefault(choice(jobs[0], 1), []).append(jobs[0])
            wants.pop(None, None)
            claims = [(choice(job, n), job) for want, rivals in wants.items() if want >= 0 for n, job in enumerate(sorted(rivals), 1)]
            if -1 in wants or not claims or any(place == -1 for place, _ in claims):
                break
            for place, job in claims:
                if place is not None:
                    won[place] = min(won.get(place, job), job)
            for place, job in won.items():
                subject = subjects[job]
                waiting[subject].popleft()
                taken[place] = True
                picks.append((ids[job], subject, names[place], now))
                places, far, bound = own[subject]
                far = np.minimum(far, nearest_sq(matrix[places], matrix[place][None]))
                own[subject] = places[far > bound], far[far > bound], bound
        return pd.DataFrame(picks, columns=["id", "subject_id", "preset_id", "round"])

    return run


def assign_rounds(
    jobs: DataFrame, catalog: DataFrame, history: DataFrame, mode: str = "rounds",
    designed: DataFrame | None = None, top: int = PREFERENCES,
) -> DataFrame:
    """Give every open job its own candidate.

    ``mode="sequential"`` follows one claim after another in (split_rank, subject, id)
    order. ``mode="rounds"`` serves one job per subject and round: the j-th job that wants
    the same first choice takes its j-th, and a candidate still wanted by several goes to the
    first of them; the others wait for the next round. ``top`` is how many choices are
    fetched at once and changes nothing else.
    Both modes give each candidate at most once and see all earlier picks of the subject.
    What is open, free and past follows from the table of picks, so a round writes its wave,
    the wave's choices and its picks, whatever it decides; the plan stays short and a lost
    executor re-reads files. Only a candidate that more than ``top`` jobs want first takes more.

    Once all subjects have a history, each gets a list of its farthest candidates, and one task
    follows the rounds that those lists decide; then new lists are made from all candidates. Lists
    hold ``LISTED`` numbers; where that leaves a subject too few candidates, where its next round is
    not decided by the lists or where names repeat, rounds are made one by one.
    """
    if mode not in ("rounds", "sequential"):
        raise ValueError(mode)
    spark = jobs.sparkSession
    if "split_rank" not in jobs.columns:
        jobs = jobs.withColumn("split_rank", F.lit(0))
    if designed is not None:
        jobs = jobs.join(designed.select(F.col("job_id").alias("id")).distinct(), "id", "left_anti")
    order = F.struct("split_rank", "subject_id", "id")
    jobs, catalog, history = pin(number_rows(jobs.select("id", "subject_id", "split_rank"), ["subject_id"], ["split_rank", "id"], "place")), pin(catalog.select("preset_id", "vector")), pin(history.select("subject_id", "vector"))
    n_jobs, n_ids, n_whole = jobs.agg(F.count("*"), F.count_distinct("id"), F.count("subject_id")).first()
    n_presets, n_names, numbers = catalog.agg(F.count("*"), F.count_distinct("preset_id"), F.max(F.size("vector"))).first()
    n_history, longest = history.count(), largest_group(history, ["subject_id"])
    several = mode == "rounds" and n_jobs == n_ids == n_whole and n_presets == n_names
    schema, path = _ROUND, scratch_path(spark, "assigned")
    width, given, turn = (top if mode == "rounds" else 1), 0, 0
    while given < n_jobs:
        if given >= n_presets:
            raise RuntimeError("free candidates are exhausted")
        won = spark.read.schema(schema).parquet(path) if turn else spark.createDataFrame([], schema)
        turn += 1
        free = catalog.join(won.select("preset_id"), "preset_id", "left_anti")
        past = history.union(won.join(catalog, "preset_id").select("subject_id", "vector"))
        known = history.select("subject_id").union(won.select("subject_id")).distinct().withColumn("warm", F.lit(True))
        waiting = jobs.join(won.select("id"), "id", "left_anti")
        wave = waiting.groupBy("subject_id").agg(F.min(order).alias("_o")).select("_o.*")
        if mode == "sequential":
            wave = wave.orderBy("split_rank", "subject_id", "id").limit(1)
        wave = pin(wave.join(known, "subject_id", "left").withColumn("warm", F.col("warm").isNotNull()))
        n_wave, n_warm = wave.agg(F.count("*"), F.count_if("warm")).first()

        parts, n_past = n_warm + (n_history + given) // HISTORY_PART, n_history + given
        room = LISTED // max(1, (numbers + 8) * n_wave)
        if several and n_warm == n_wave and room >= LEAST_LISTED:
            ahead = max(1, AHEAD_ROWS // n_wave)
            pairs, blocks = _block_pairs(wave, free, past, PACKED, HISTORY_PART, (parts, n_past, n_presets - given), longest + turn)
            lists = pairs.applyInPandas(_lists_of_block(math.ceil(room / blocks)), _LIST).withColumn("_all", F.lit(0))
            first = waiting.groupBy("subject_id").agg(F.min("place").alias("_first"))
            queue = waiting.join(first, "subject_id").filter(F.col("place") < F.col("_first") + ahead).select("id", "subject_id", "split_rank", F.lit(0).alias("_all"))
            lists.groupBy("_all").cogroup(queue.groupBy("_all")).applyInPandas(_rounds_of_lists(turn, ahead), schema).write.mode("append").parquet(path)
            n_won, last = spark.read.schema(schema).parquet(path).agg(F.count("*"), F.max("round")).first()
            if n_won > given:
                given, turn = n_won, last
                continue

        def choices(some: DataFrame, k: int, n_some: int, n_warm: int) -> DataFrame:
            """The first ``k`` choices of each job of some of the wave."""
            found = None
            if n_warm:
                found = preferences(some.filter("warm"), free, past, k, sizes=(parts, n_past, n_presets - given), longest=longest + turn).select("id", "choice", "preset_id")
            if n_some > n_warm:
                cold = some.filter("NOT warm").select("id", "subject_id")
                chosen = cold.join(cold_preferences(cold, free, k, size=n_presets - given), "subject_id").select("id", "choice", "preset_id")
                found = chosen if found is None else found.unionByName(chosen)
            return found.join(some, "id").select("id", "choice", "preset_id", "subject_id", "split_rank")

        fetched = pin(choices(wave, width, n_wave, n_warm))
        first = fetched.filter("choice = 1")
        claims = first
        if mode == "rounds":
            last = largest_group(first, ["preset_id"])
            rival, by = first.select("id", "split_rank", "subject_id", "preset_id"), ["split_rank", "subject_id", "id"]
            if last <= GROUP_ROWS:
                rival = rival.withColumn("turn", F.row_number().over(Window.partitionBy("preset_id").orderBy(*by)))
            else:
                rival = number_rows(rival, ["preset_id"], by, "turn")
            rival = rival.select("id", "turn")
            claims = fetched.join(rival.select("id", F.col("turn").alias("choice")), ["id", "choice"]).select(*fetched.columns)
            low = width
            while low < last:
                high = low * 4
                later = pin(wave.join(rival.filter((F.col("turn") > low) & (F.col("turn") <= high)), "id"))
                n_later, n_warm = later.agg(F.count("*"), F.count_if("warm")).first()
                wanted = choices(later.drop("turn"), high, n_later, n_warm).join(later.select("id", F.col("turn").alias("choice")), ["id", "choice"])
                claims = claims.unionByName(pin(wanted.select(*claims.columns)))
                low = high
        picks = claims.groupBy("preset_id").agg(F.min(order).alias("_o")).select("_o.id", "_o.subject_id", "preset_id", F.lit(turn).alias("round"))
        picks.write.mode("append").parquet(path)
        given = spark.read.schema(schema).parquet(path).count()
    return spark.read.schema(schema).parquet(path) if turn else spark.createDataFrame([], schema)
