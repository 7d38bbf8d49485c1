"""Small hand-made cases: restatements of iterative operators and negative cases one by one."""

import hashlib
import math
import random

import numpy as np
import pytest

from cliploom.operators import diversity, gates, integrity, kernels, proximity, queue, tree
from cliploom.operators.recurrences import clamp_series


def stable(text):
    return int(hashlib.sha1(text.encode()).hexdigest()[:16], 16)


def claim_in_order(jobs, catalog, history):
    """One claim after another, written from the description of the assignment."""
    free, past, given = dict(catalog), {s: list(v) for s, v in history.items()}, {}
    for job, subject in sorted(jobs, key=lambda j: (j[1], j[0])):
        if not past.get(subject):
            ranked = sorted(free, key=lambda p: stable(f"{subject}:{p}"))
            pick = ranked[len(ranked) // 3]
        else:
            near = {p: min(math.dist(v, h) for h in past[subject]) for p, v in free.items()}
            pick = max(free, key=lambda p: (near[p], -stable(f"{subject}:{job}:{p}")))
        given[job] = pick
        past.setdefault(subject, []).append(free.pop(pick))
    return given


@pytest.fixture(scope="module")
def assignment(spark):
    rng = random.Random(5)
    catalog = {f"p{i}": [rng.random() for _ in range(4)] for i in range(12)}
    jobs = [(1, "a"), (2, "a"), (3, "b")]
    history = {"b": [[0.5, 0.5, 0.5, 0.5]]}
    frames = (
        spark.createDataFrame(jobs, "id long, subject_id string"),
        spark.createDataFrame(list(catalog.items()), "preset_id string, vector array<double>"),
        spark.createDataFrame([(s, v) for s, vs in history.items() for v in vs], "subject_id string, vector array<double>"),
    )
    return jobs, catalog, history, frames


def test_sequential_assignment_equals_claims_in_order(assignment):
    jobs, catalog, history, frames = assignment
    rows = diversity.assign_rounds(*frames, mode="sequential").collect()
    assert {r.id: r.preset_id for r in rows} == claim_in_order(jobs, catalog, history)


def test_rounds_give_every_job_its_own_candidate(assignment):
    jobs, _, _, frames = assignment
    rows = diversity.assign_rounds(*frames).collect()
    assert sorted(r.id for r in rows) == [j for j, _ in jobs]
    assert len({r.preset_id for r in rows}) == len(jobs)


@pytest.mark.parametrize("top", [1, 8])
def test_rounds_do_not_depend_on_what_is_fetched_at_once(spark, top):
    rng = random.Random(6)
    catalog = spark.createDataFrame([(f"p{i}", [rng.random() for _ in range(3)]) for i in range(60)], "preset_id string, vector array<double>")
    jobs = spark.createDataFrame([(i, f"s{i % 14}") for i in range(28)], "id long, subject_id string")
    history = spark.createDataFrame([(f"s{i}", [0.5, 0.5, 0.5]) for i in range(12)], "subject_id string, vector array<double>")
    found = {tuple(r) for r in diversity.assign_rounds(jobs, catalog, history, top=top).collect()}
    assert found == {tuple(r) for r in diversity.assign_rounds(jobs, catalog, history, top=64).collect()}
    assert len(found) == len({f[2] for f in found}) == 28


def test_long_history_in_parts_and_blocks_changes_nothing(spark, assignment):
    _, catalog, _, (jobs, free, _) = assignment
    rng = random.Random(9)
    past = [("a", [rng.random() for _ in range(4)]) for _ in range(30)]
    history = spark.createDataFrame(past, "subject_id string, vector array<double>")
    whole = {r.id: r.preset_id for r in diversity.pick_diverse(jobs, free, history).collect()}
    split = {r.id: r.preset_id for r in diversity.pick_diverse(jobs, free, history, block=5, history_part=4).collect()}
    best = max(catalog, key=lambda p: min(math.dist(catalog[p], v) for _, v in past))
    assert whole == split == {1: best, 2: best}


def test_order_stats_with_one_value_filling_a_group(spark):
    rows = [("hot", 7.0)] * 500 + [("hot", float(i)) for i in range(40)] + [("cold", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    out = {r.k: (r.n, r.mid, r.p95) for r in kernels.order_stats(df, ["k"], "v", {"mid": kernels.middle, "p95": kernels.p95_rank}, 10).collect()}
    values = sorted(v for k, v in rows if k == "hot")
    n = len(values)
    assert out["hot"] == (n, values[n // 2], values[min(n - 1, int(0.95 * n))]) and out["cold"] == (1, 1.0, 1.0)


def test_clamp_matches_plain_loop():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(200, 3)) * 0.1
    expected = [points[0]]
    for p in points[1:]:
        step = p - expected[-1]
        size = np.linalg.norm(step)
        expected.append(p if size <= 0.12 else expected[-1] + step / size * 0.12)
    assert np.allclose(clamp_series(points, 0.12, None)[0], expected)


def test_steps_that_never_settle_take_few_rounds(spark, monkeypatch):
    from cliploom.operators import recurrences

    rounds = []
    write = recurrences.scratch_path
    monkeypatch.setattr(recurrences, "scratch_path", lambda *a: rounds.append(a) or write(*a))
    pinned = recurrences.pin
    pins = []
    monkeypatch.setattr(recurrences, "pin", lambda df: pins.append(1) or pinned(df))
    points = np.array([[i * 1.0, 0.0, 0.0] for i in range(2000)])  # the limit is never caught up with
    df = spark.createDataFrame([("c", i, p.tolist(), 0.1) for i, p in enumerate(points)], "clip string, frame long, p array<double>, limit double")
    out = recurrences.clamp_steps(df, ["clip"], "frame", "p", "limit", 2)
    got = [r.clamped for r in out.orderBy("frame").collect()]
    assert np.allclose(got, clamp_series(points, 0.1, None)[0])
    assert len(pins) < 25 and len(out._jdf.queryExecution().toString()) < 30_000


def test_chunks_that_agree_again_are_not_read_in_order(spark, monkeypatch):
    from pyspark.sql import functions as F

    from cliploom.operators import recurrences

    paths = []
    write = recurrences.scratch_path
    monkeypatch.setattr(recurrences, "scratch_path", lambda *a: paths.append(write(*a)) or paths[-1])
    i = np.arange(2000)
    bursts = np.minimum(i, 20) * 0.2 + np.clip(i - 1000, 0, 100) * 0.2 + np.clip(i - 1500, 0, 20) * 0.2
    clips = {"still": np.zeros(2000), "bursts": bursts, "steady": i * 0.2}
    rows = [(c, int(k), [float(v), 0.0, 0.0], 0.1) for c, values in clips.items() for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "clip string, frame long, p array<double>, limit double")
    out = recurrences.clamp_steps(df, ["clip"], "frame", "p", "limit", 2).orderBy("frame").collect()
    for c, values in clips.items():
        expected, hit = clamp_series(np.array([[v, 0.0, 0.0] for v in values]), 0.1, None)
        got = [r for r in out if r.clip == c]
        assert np.allclose([r.clamped for r in got], expected) and [r.repaired for r in got] == hit.tolist()
    late = spark.read.parquet(paths[0]).filter(F.col("_version") > recurrences.REPEATS).groupBy("clip").count().collect()
    late = {r["clip"]: r["count"] for r in late}
    assert "still" not in late and late["bursts"] < 500 and late["steady"] < 2200


def test_proximity_finds_distant_and_close_pairs(spark):
    rng = random.Random(1)
    rows = []
    for frame, shift in ((0, 0.0), (1, 0.7), (2, 3.0)):
        for region in ("left_hand", "right_hand", "torso_and_legs"):
            for _ in range(40):
                x = rng.random() * 0.05 + (shift if region == "left_hand" else 0.0)
                rows.append(("c", frame, region, x, rng.random() * 0.05, rng.random()))
    df = spark.createDataFrame(rows, "clip string, frame long, region string, x double, y double, z double")
    got = {(r.frame, r.pair): (r.minimum, r.close_points) for r in proximity.proximity_frames(df, close=0.02).collect()}
    assert len(got) == 9
    for (frame, pair), (minimum, close) in got.items():
        q, o = proximity.PAIRS[pair]
        pts = [r for r in rows if r[1] == frame]
        height = max(r[5] for r in pts) - min(r[5] for r in pts)
        near = [min(math.dist(a[3:], b[3:]) / height for b in pts if b[2] == o) for a in pts if a[2] == q]
        assert math.isclose(minimum, min(near), rel_tol=1e-9) and close == sum(d <= 0.02 for d in near)


def test_missing_region_is_not_available_but_passes(spark):
    clips = spark.createDataFrame([("c",)], "clip string")
    qc = spark.createDataFrame([("c", "left_to_right_hand", True)], "clip string, pair string, severe boolean")
    row = proximity.collision_status(clips, qc).first()
    assert (row.collision_status, row.gate) == ("not_available", "passed")


def test_common_ancestors_equal_lists_of_ancestors(spark):
    rng = random.Random(2)
    up = {("t", i): None if i in (0, 1) else rng.randrange(max(0, i - 6), i) for i in range(80)}
    label = lambda i: f"pelvis{i}" if i is not None and i % 17 == 3 else None if i is None else f"n{i}"
    nodes = spark.createDataFrame([(t, label(i), label(p)) for (t, i), p in up.items()], "tree string, name string, parent string")

    def line(i):
        out = [i]
        while up["t", out[-1]] is not None:
            out.append(up["t", out[-1]])
        return out

    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(150)] + [(5, 5), (0, 1)]
    expected = {}
    for a, b in pairs:
        both = [x for x in line(a) if x in line(b)]
        if both:
            expected[label(a), label(b)] = label(next((x for x in both if "pelvis" in label(x)), both[0]))
    found = tree.common_ancestor(nodes, spark.createDataFrame([("t", label(a), label(b)) for a, b in pairs], "tree string, left string, right string"), ["tree"]).collect()
    assert {(r["left"], r["right"]): r.ancestor for r in found} == expected and len(found) == len(expected)


def test_frequent_nodes_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(tree, "HOT_ROWS", 20)
    label = lambda i: "root" if i == 1 else f"n{i}"
    rows = [("t", label(i), None if i == 1 else label(i // 2)) for i in range(1, 64)]
    nodes = spark.createDataFrame([*rows, ("t", "n9", "n4")], "tree string, name string, parent string")  # one node comes twice
    table = nodes.selectExpr("tree", "name AS node", "parent AS up")
    pairs = spark.createDataFrame([("t", label(a), label(b)) for a in range(32, 64) for b in (2, 5, 9, a)], "tree string, left string, right string")
    sides = {"left": "_a", "right": "_b"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner"):
            plain = pairs
            for side, out in sides.items():
                plain = plain.join(table.selectExpr("tree", f"node AS {side}", f"up AS {out}"), ["tree", side], how)
            found = tree._look_up(pairs, table, ["tree"], sides, how).select(plain.columns)
            assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
            assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
        found = tree.common_ancestor(nodes.distinct(), pairs, ["tree"])
        assert {(r["left"], r["right"]): r.ancestor for r in found.collect()}["n63", "n2"] == "root" and found.count() == pairs.distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cycle_in_hierarchy_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(tree, "MAX_ROUNDS", 4)
    loop = spark.createDataFrame([("r", "a", "b"), ("r", "b", "a")], "rig string, name string, parent string")
    with pytest.raises(RuntimeError):
        tree.depth(loop, ["rig"])


JOB = "id long, subject_id string, asset_path string, sample_id string, split string, status string, worker_id string, pid long, attempts long, started_at timestamp, finished_at timestamp, error string"


def job(i, subject="s", status="pending", attempts=2):
    return (i, subject, f"/a/{subject}", f"clip-{i}", "train", status, "w", 5, attempts, None, None, "old")


def retry_case(spark, jobs, ids, pairs=("clip-1", "clip-2"), done=()):
    table = spark.createDataFrame(jobs, JOB)
    checks = queue.retry_checks(
        table, spark.createDataFrame([(i,) for i in ids], "job_id long"),
        spark.createDataFrame([("s", "human"), ("t", "prop")], "subject_id string, asset_kind string"),
        spark.createDataFrame([(p, "lib://b.mp4") for p in pairs], "sample_id string, background_ref string"), {"lib": "/bg"},
        spark.createDataFrame([("/a/s",), ("/a/t",), ("/bg/b.mp4",)], "path string"),
        spark.createDataFrame(list(done), "split string, sample_id string"),
    )
    nxt, events = queue.retry(table, checks, "fixed")
    return {r.id: r for r in nxt.collect()}, events.collect(), {r.id: r.reason for r in checks.collect()}


def test_valid_retry_resets_but_keeps_attempts(spark):
    nxt, events, _ = retry_case(spark, [job(1, status="failed"), job(2, status="done")], [1])
    assert (nxt[1].status, nxt[1].attempts, nxt[1].error, nxt[1].worker_id) == ("pending", 2, None, None)
    assert nxt[2].status == "done" and [e.event for e in events] == ["explicit_retry"]


@pytest.mark.parametrize("jobs,ids,kwargs,reason", [
    ([job(1, status="failed"), job(2, status="done")], [1, 2], {}, "absent_or_not_retryable"),
    ([job(1, status="failed")], [1, 9], {}, "absent_or_not_retryable"),
    ([job(1, status="failed"), job(2, "t", "failed")], [1, 2], {}, "subject_not_human"),
    ([job(1, status="failed"), job(2, status="failed")], [1, 2], {"pairs": ("clip-1",)}, "background_missing"),
    ([job(1, status="failed"), job(2, status="failed")], [1, 2], {"done": [("train", "clip-2")]}, "output_exists"),
])
def test_one_bad_request_changes_nothing(spark, jobs, ids, kwargs, reason):
    nxt, events, reasons = retry_case(spark, jobs, ids, **kwargs)
    assert {i: r.status for i, r in nxt.items()} == {j[0]: j[5] for j in jobs}
    assert not events and reasons[ids[1]] == reason


def test_running_job_blocks_retry(spark):
    nxt, events, _ = retry_case(spark, [job(1, status="failed"), job(2, "t", "running")], [1])
    assert nxt[1].status == "failed" and not events


def test_three_subjects_four_jobs_dispatch(spark):
    rows = [job(1, "a"), job(2, "a"), job(3, "b"), job(4, "c"), job(5, "d"), job(6, "d", "running")]
    wave = queue.dispatch_wave(spark.createDataFrame(rows, JOB)).collect()
    assert sorted((r.subject_id, r.id) for r in wave) == [("a", 1), ("b", 3), ("c", 4)]


def test_pins_and_paths(spark):
    facts = spark.createDataFrame([("m", True, 1, "aa")], "path string, exists boolean, bytes long, sha256 string")
    assert [r.verdict for r in integrity.validate_release(facts, {"m": "aa"}).collect()] == ["ok"]
    refs = spark.createDataFrame([("lib://a/b",), ("lib://../b",), ("lib:///b",), ("x://a",), ("plain",)], "ref string")
    got = [r.ref_verdict for r in queue.resolve_refs(refs, "ref", {"lib": "/r"}).collect()]
    assert got == ["ok", "unsafe_path", "unsafe_path", "unknown_reference", "unknown_reference"]


@pytest.mark.parametrize(("response", "status", "score"), [
    ("no", "no_json", None), ('x {"score": 8', "no_json", None), ('{"score": 8, }', "bad_json", None), ('{"score": "high"}', "bad_score", None),
    ('{"score": "8.5", FLAGS}', "passed", 0.85), ('{"score": true, FLAGS}', "passed", 1.0), ('{"score": 0.71, FLAGS}', "passed", 0.71), ("{FLAGS}", "failed", 0.0),
    ('{"score": 9, "perspective_consistent": "yes", "scale_consistent": 1, "placement_stable": [0], "physically_plausible": {"a": 0}}', "passed", 0.9),
    ('{"score": 9, "perspective_consistent": "", "scale_consistent": 1, "placement_stable": 1, "physically_plausible": 1}', "failed", 0.9),
    ('{"score": 9, "perspective_consistent": 1, "scale_consistent": 0.0, "placement_stable": 1, "physically_plausible": 1}', "failed", 0.9),
    ('{"score": 9, "perspective_consistent": 1, "scale_consistent": [], "placement_stable": 1, "physically_plausible": 1}', "failed", 0.9),
    ('{"score": 9, "perspective_consistent": 1, "scale_consistent": null, "placement_stable": 1, "physically_plausible": 1}', "failed", 0.9),
])
def test_answers(spark, response, status, score):
    flags = ", ".join(f'"{f}": true' for f in gates.ANSWER_FLAGS)
    rows = spark.createDataFrame([(response.replace("FLAGS", flags), "halfbody")], "response string, framing string")
    got = gates.answer_gate(rows).first()
    assert (got.status, got.score) == (status, score)


def test_points_that_are_not_finite_are_counted_and_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("c", 0, "left_hand", 0.0, 0.0, 0.0), ("c", 0, "left_hand", nan, 0.0, 0.0), ("c", 0, "right_hand", 5e4, 0.0, 1.0), ("c", 0, "right_hand", 1.0, -inf, 0.5), ("c", 0, "right_hand", None, 0.0, 0.5)]
    df = spark.createDataFrame(rows, "clip string, frame long, region string, x double, y double, z double")
    got = proximity.proximity_frames(df).collect()
    assert [(r.pair, r.points, r.close_points, r.invalid_points) for r in got] == [("left_to_right_hand", 1, 0, 3)]
    assert math.isclose(got[0].minimum, math.sqrt(5e4**2 + 1))


def test_job_without_a_source_has_no_fingerprint(spark):
    from cliploom.operators.provenance import SOURCE_ROLES, input_fingerprint

    paths = dict(zip(SOURCE_ROLES, "abc", strict=True))
    jobs = spark.createDataFrame([(1, *paths.values()), (2, "a", "b", "gone"), (3, None, "b", "c")], "id long, " + ", ".join(f"{r} string" for r in SOURCE_ROLES))
    facts = spark.createDataFrame([("a", True, 1, 1, "x"), ("b", True, 2, 2, "y"), ("c", True, 3, 3, "z")], "path string, exists boolean, bytes long, mtime_ns long, sha256 string")
    got = {r["id"]: r for r in input_fingerprint(jobs, facts).collect()}
    assert got[1].input_fingerprint and got[1].missing_source is None
    assert (got[2].input_fingerprint, got[2].missing_source) == (None, SOURCE_ROLES[2])
    assert (got[3].input_fingerprint, got[3].missing_source) == (None, SOURCE_ROLES[0])


def test_records_hold_every_field_and_the_references(spark):
    from cliploom.operators import provenance as P

    roles = ", ".join(f"{r} string" for r in P.SOURCE_ROLES)
    jobs = spark.createDataFrame([(1, "s1", "train", "h", *["/video/p"] * 3, "x"), (2, "s2", "test", "h", "/video/p", "/video/gone", "/video/p", None)], f"id long, sample_id string, split string, subject_id string, {roles}, production_setting string")
    files = spark.createDataFrame([("p", "p.tar.zst", "h1")], "path string, archive string, sha256 string")
    facts = spark.createDataFrame([("p", "h1"), ("/video/p", "h1"), ("/code/setting.json", "h2")], "path string, sha256 string").selectExpr("path", "true AS exists", "1L AS bytes", "2L AS mtime_ns", "sha256")
    bind = lambda repo="a/set", held="m": spark.createDataFrame([(repo, "u", "r7", "hf_download", {P.FILE_MANIFEST: "m"}, "/video", held)], P.BINDING)
    refs = P.source_refs(jobs, files, facts, bind())
    reports = spark.createDataFrame([(1, "completed", None, "a", "{}", "3.11", "gpu0"), (2, "failed", "e", "b", None, "3.11", "gpu1")], "job_id long, status string, error string, attempt string, runtime_report string, python string, gpu_uuid string")
    release = spark.createDataFrame([("v1",)], "tag string")
    rows = P.build_records(jobs, facts, reports, "/out", {"w.py": "0"}, refs, bind(), release, "/code/setting.json", "not to be used alone")
    got = {r.job_id: r for r in rows.collect()}
    assert len(rows.columns) == len(set(rows.columns)) == 37 and got.keys() == {1, 2}
    assert got[1].dataset_source_refs["background_path"].asDict() == {
        "repo_id": "a/set", "repo_url": "u", "revision": "r7", "origin": "hf_download", "file_manifest_sha256": "m", "archive_path": "p.tar.zst", "path_in_root": "p", "sha256": "h1",
    }
    assert len(got[1].dataset_source_refs) == 3 and got[2].dataset_source_refs is None
    assert got[1].asset_source_binding.resolved_revision == "r7" and got[1].asset_release.tag == "v1"
    assert (got[1].setting, got[2].setting, got[1].setting_file.sha256) == ("x", None, "h2")
    assert (got[2].environment.gpu_uuid, got[2].environment.blender_bin, got[1].limitations) == ("gpu1", None, "not to be used alone")
    bare = P.build_records(jobs, facts, reports, "/out", {"w.py": "0"}, setting_path="/code/none").filter("job_id = 1").first()
    assert (bare.asset_source_binding, bare.dataset_source_refs, bare.asset_release, bare.setting_file.exists) == (None, None, None, False)
    for binding, problem in ((bind("other"), "invalid_binding"), (bind(None), "invalid_binding"), (bind(held="n"), "invalid_binding"), (bind().limit(0), "not_bound"), (bind().union(bind()), "invalid_binding")):
        assert [(r.problem, r.refs) for r in P.source_refs(jobs, files, facts, binding, "/video", data_set="a/set").collect()] == [(problem, {})] * 2


def test_jobs_are_not_shuffled_by_their_sources(spark):
    from cliploom.operators import provenance as P

    roles = ", ".join(f"{r} string" for r in P.SOURCE_ROLES)
    jobs = spark.createDataFrame([(i, f"s{i}", "train", "h", "/p", "/q" if i % 2 else None, "/p") for i in range(6)], f"id long, sample_id string, split string, subject_id string, {roles}")
    facts = spark.createDataFrame([("/p", "h1", 1), ("/p", "h2", 2), ("/q", "h3", None), (None, "h4", 4)], "path string, sha256 string, bytes long").selectExpr("path", "true AS exists", "bytes", "2L AS mtime_ns", "sha256")
    reports = jobs.selectExpr("id AS job_id", "'completed' AS status", "'' AS error", "'a' AS attempt", "'{}' AS runtime_report")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = P.build_records(jobs, facts, reports, "/out", {"w.py": "0"})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert not any(f"hashpartitioning({role}" in plan for role in P.SOURCE_ROLES)
        got = sorted((r.job_id, r.asset.sha256, r.background.sha256, r.motion and r.motion.sha256) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted((i, a, b, "h3" if i % 2 else None) for i in range(6) for a in ("h1", "h2") for b in ("h1", "h2"))


def test_replay_gate_shuffles_no_text(spark, folder):
    from cliploom.operators import provenance as P
    from cliploom.plans import CATALOGUE

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = CATALOGUE["replay_gate"].run(spark, folder)
        nodes = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted").split("\n\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [n for n in nodes if "Exchange" in n.strip().split("\n")[0] and "Input" in n]
    assert moved and not [n for n in moved if "text#" in n]

    held = lambda p, h: {"path": p, "sha256": h}
    source = "struct<path string, sha256 string>"
    rows = [(1, held("/p", "h"), held("/q", "i"), held("/p", "h")), (1, held("/p", "h"), held("/q", "x"), held("/p", None)), (2, held("/p", "h"), held("/p", "h"), held("/gone", "h")), (3, held("/p", "h"), held("/p", "h"), held("/p", "h"))]
    records = spark.createDataFrame(rows, f"record long, asset {source}, motion {source}, background {source}")
    facts = spark.createDataFrame([("/p", "h"), ("/q", "i")], "path string, sha256 string")
    code = spark.createDataFrame([(i, "a", "m", "b", "{}") for i in (1, 2, 3)], "record long, asset_path string, motion_path string, background_path string, action_params_json string")
    got = P.replay_gate(records, facts, code, spark.createDataFrame([], "record long")).collect()
    assert sorted(map(tuple, got)) == [(1, "source_changed:motion")] * 2 + [(2, "source_changed:background"), (3, "ok")]


def test_same_result_at_any_partition_count(spark, folder):
    from cliploom.plans import CATALOGUE

    seen = set()
    for n in ("1", "4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.add(tuple(sorted(map(tuple, CATALOGUE["trajectory_qc_presets"].run(spark, folder).collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(seen) == 1


def test_malformed_and_corrupt_lines_are_kept_apart(spark, tmp_path):
    from cliploom.schemas import FILES
    from cliploom.sources.readers import read_manifest

    (tmp_path / "m.jsonl").write_text('{"path":"a","archive":"x","sha256":"1"}\n{broken\n')
    rows = read_manifest(spark, str(tmp_path / "m.jsonl"), FILES, keep_corrupt=True).collect()
    assert {(r.path, r._corrupt_record) for r in rows} == {("a", None), (None, "{broken")}


def test_unused_ignores_malformed_payloads(spark):
    from cliploom.operators.catalog import unused

    c = spark.createDataFrame([("p1",), ("p2",)], "preset_id string")
    d = spark.createDataFrame([('{"id":"p1"}',), ("{bad",), (None,)], "action_params_json string")
    assert [r.preset_id for r in unused(c, d, "preset_id", "$.id").collect()] == ["p2"]


def test_silence_begins_after_more_than_the_timeout(spark, tmp_path):
    from datetime import datetime, timedelta

    from cliploom.streaming import streams

    begin = datetime(2026, 1, 1)
    hours = {1: [0, 6, 12, 40], 2: [0, 6.001, 50], 3: [60]}
    events = [(job, begin + timedelta(hours=h)) for job, hs in hours.items() for h in hs]
    for k, late in enumerate((20, 100)):
        some = [e for e in events if (late == 100) != (e[1] < begin + timedelta(hours=20))]
        spark.createDataFrame(some, "job_id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = streams.stream_stale(streams.file_stream(spark, f"{tmp_path}/in", "job_id long, ts timestamp", 1), "21600 seconds")
    found = {(r["job_id"], (r["silent_since"] - begin) / timedelta(hours=1)) for r in streams.drain_append(stream, f"{tmp_path}/out").collect()}
    # exactly six hours go on, a little more does not; the watermark ends at hour 54
    assert found == {(1, 12.0), (1, 40.0), (2, 0.0), (2, 6.001)}


def _arrive(spark, path, schema, steps):
    for rows in steps:  # one file for each step, read in this order
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_live_reports_follow_the_claims(spark, tmp_path):
    from datetime import datetime, timedelta

    from cliploom.streaming import streams

    at = lambda hours: datetime(2026, 1, 1) + timedelta(hours=hours)
    report, claim = "job_id long, attempt string, ts timestamp", "job_id long, attempt string, ts timestamp, claim_id long"
    end = [(9, "z", at(200))]
    reports = [
        [(1, "a", at(1)), (2, "a", at(1)), (2, "b", at(2)), (4, "a", at(20)), (None, "a", at(1)), (5, None, at(1))],
        [(1, "a", at(11)), (1, "b", at(11)), (1, "b", at(11)), (3, "a", at(12)), (1, "b", at(12))],
        end, end, [(1, "b", at(11.5)), (9, "z", at(200))],
    ]
    claims = [
        [(1, "a", at(0), 1), (2, "a", at(0), 2), (2, "b", at(0), 3), (4, "a", at(0), 7), (None, "a", at(0), 8), (5, None, at(0), 9)],
        [(1, "b", at(10), 4)], [(9, "z", at(200), 5)], [(9, "z", at(200), 6)], [(9, "z", at(200), 10)],
    ]
    _arrive(spark, f"{tmp_path}/r", report, reports)
    _arrive(spark, f"{tmp_path}/c", claim, claims)
    sides = [streams.file_stream(spark, f"{tmp_path}/r", report, 1), streams.file_stream(spark, f"{tmp_path}/c", claim, 1)]
    live = streams.stream_live_reports(*sides, "2 hours", "12 hours").writeStream.outputMode("append").format("parquet")
    query = live.option("checkpointLocation", f"{tmp_path}/k").trigger(availableNow=True).start(f"{tmp_path}/o")
    query.awaitTermination()
    told = lambda df: {(r.job_id, r.attempt, (r.reported_at - at(0)) / timedelta(hours=1), r.claim_id) for r in df.collect()}
    on_time = {(1, "a", 1.0, 1), (2, "b", 2.0, 3), (1, "b", 11.0, 4), (1, "b", 12.0, 4)}
    assert told(spark.read.parquet(f"{tmp_path}/o")) == on_time
    fixed = streams.stream_live_reports(spark.read.parquet(f"{tmp_path}/r"), spark.read.parquet(f"{tmp_path}/c"), "2 hours", "12 hours")
    # the report that came after its time was dropped; job 9 is not settled
    assert told(fixed) == on_time | {(1, "b", 11.5, 4), (9, "z", 200.0, 10)}
    held = {o["operatorName"]: o["numRowsTotal"] for o in query.lastProgress["stateOperators"]}
    assert held == {"symmetricHashJoin": 6, "stateStoreSave": 1}  # only hour 200: three reports, three claims, one report to tell
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 1


def test_late_telemetry_is_dropped(spark, tmp_path):
    from datetime import datetime, timedelta

    from cliploom.streaming import streams

    at = lambda hours: datetime(2026, 1, 1) + timedelta(hours=hours)
    schema = "run long, ts timestamp, memory_used_mib double, utilization double"
    steps = [[(1, at(0.5), 10.0, 50.0), (1, at(5), 20.0, 10.0)], [(1, at(3.2), 5.0, 30.0), (1, at(5.5), 1.0, 30.0)], [(1, at(0.6), 99.0, 99.0), (1, at(4.5), 7.0, 70.0)]]
    _arrive(spark, f"{tmp_path}/in", schema, steps)
    stream = streams.stream_telemetry(streams.file_stream(spark, f"{tmp_path}/in", schema, 1), "1 hour", "2 hours")
    streams.drain_deltas(stream, f"{tmp_path}/out")
    rows = streams.fold_deltas(spark, f"{tmp_path}/out", ["run", "window_start"]).collect()
    found = {((r.window_start - at(0)) / timedelta(hours=1), r.peak_memory_mib, r.mean_utilization, r.samples) for r in rows}
    # the watermark is hour 3 when the last file arrives: of its rows the first is too late
    assert found == {(0.0, 10.0, 50.0, 1), (3.0, 5.0, 30.0, 1), (4.0, 7.0, 70.0, 1), (5.0, 20.0, 20.0, 2)}


@pytest.mark.parametrize("size", [2, 9, 4096])
def test_affine_scan(spark, size):
    from cliploom.operators import kernels as K

    rng = np.random.default_rng(3)
    maps = {k: [(0.0 if rng.random() < 0.1 else float(rng.normal()), rng.normal(size=2).tolist()) for _ in range(n)] for k, n in (("long", 500), ("one", 1), ("short", 7))}
    df = spark.createDataFrame([(k, i, a, b) for k, own in maps.items() for i, (a, b) in enumerate(own)], "k string, i long, a double, b array<double>")
    got = {(r.k, r.i): r.state for r in K.affine_scan(df, ["k"], "i", "a", "b", "state", 499, size).collect()}
    for k, own in maps.items():
        state = np.zeros(2)
        for i, (a, b) in enumerate(own):
            state = a * state + np.array(b)
            assert np.allclose(got[k, i], state, rtol=1e-9, atol=1e-9)


def test_affine_scan_begins_anew_behind_what_is_not_finite(spark):
    from cliploom.operators import kernels as K

    df = spark.createDataFrame([("k", 0, 1.0, [float("nan")]), ("k", 1, 0.0, [2.0]), ("k", 2, 0.5, [1.0])], "k string, i long, a double, b array<double>")
    assert [r.state for r in K.affine_scan(df, ["k"], "i", "a", "b", "state", 2).orderBy("i").collect()][1:] == [[2.0], [2.0]]


@pytest.mark.parametrize("size", [9, 4096])
@pytest.mark.parametrize("dims", [1, 3])
def test_contact_runs_are_a_scan_in_the_jvm(spark, monkeypatch, size, dims):
    """Against the walk over runs; one clip holds nearly all rows; at most two tables are written and no Python worker runs."""
    from cliploom.operators import recurrences as R

    rng = np.random.default_rng(dims)
    clips = {"hot": 700, "short": 12, "still": 30}
    contact = {c: (rng.random(n) < 0.55) if c != "still" else np.zeros(n, bool) for c, n in clips.items()}
    contact["hot"][:300] = np.arange(300) % 2 == 0  # each run begins one frame behind the one before
    points = {c: rng.normal(size=(n, dims)) for c, n in clips.items()}
    rows = [(c, i, bool(contact[c][i]), points[c][i].tolist()) for c, n in clips.items() for i in range(n)]
    df = spark.createDataFrame(rows, "clip string, frame long, contact boolean, p array<double>")
    pins = []
    pinned = R.pin
    monkeypatch.setattr(R, "pin", lambda x: pins.append(1) or pinned(x))
    out = R.contact_runs(df, ["clip"], "frame", "contact", "p", dims, size)
    assert len(pins) == 2
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    got = {(r.clip, r.frame): r.stabilized for r in out.collect()}
    weight = lambda d: (lambda x: x * x * (3 - 2 * x))((3 - d) / 3)
    for c, n in clips.items():
        made = points[c].copy()
        for b in range(n):
            if contact[c][b] and (b == 0 or not contact[c][b - 1]):
                e = b
                while e + 1 < n and contact[c][e + 1]:
                    e += 1
                anchor = made[b : e + 1].mean(axis=0)
                made[b : e + 1] = anchor
                for d in (1, 2):
                    for f in (b - d, e + d):
                        if 0 <= f < n:
                            made[f] += (anchor - made[f]) * weight(d)
        assert np.allclose([got[c, f] for f in range(n)], made)


def test_ranks_of_a_million_values_without_a_range_sort(spark):
    from pyspark.sql import functions as F

    from cliploom.operators import kernels as K

    n = 1_000_000
    df = spark.range(n).select(F.lit("hot").alias("g"), F.expr("exp(id * 1e-5) * (1 + pmod(xxhash64(id), 7))").alias("v"))
    df = df.union(spark.range(10).select(F.lit("small"), F.col("id").cast("double")))
    picks = {"low": K.lower_quartile, "mid": K.middle, "high": K.p95_rank, "first": lambda n: n * 0, "last": lambda n: n - 1}
    out = K.order_stats(df, ["g"], "v", picks, group_rows=50_000)
    assert "rangepartitioning" not in out._jdf.queryExecution().toString().lower()
    got = {r.g: r.asDict() for r in out.collect()}
    for g in ("hot", "small"):
        v = np.sort([r.v for r in df.filter(F.col("g") == g).select("v").collect()])
        ranks = {"low": len(v) // 4, "mid": len(v) // 2, "high": min(len(v) - 1, int(len(v) * 0.95)), "first": 0, "last": len(v) - 1}
        assert got[g] == {"g": g, "n": len(v)} | {k: v[i] for k, i in ranks.items()}


@pytest.mark.parametrize("kind", ["double", "long", "decimal(20,3)"])
@pytest.mark.parametrize("by", [["g"], []])
def test_narrowed_ranks_of_odd_values(spark, kind, by):
    """Ties, huge neighbours that are one double, infinities and NaN; every rank, also with two cells only."""
    from cliploom.operators import kernels as K

    rng = np.random.default_rng(4)
    values = [int(v) for v in rng.integers(-50, 50, 120)] + [9, 9, 9, 2**60, 2**60 + 1, 2**60 + 2, -(2**60)] if kind == "long" else [float(v) for v in rng.normal(size=100)] + [0.5] * 40 + [1e5, 0.0, -0.0]
    if kind == "double":
        values += [float("inf"), float("-inf"), float("nan"), 1e308, -1e308, 5e-324]
    rows = [(k % 2 if by else 0, v) for k, v in enumerate(values)] + [(0, None)]
    df = spark.createDataFrame(rows, f"g long, v {'double' if kind != 'long' else 'long'}").selectExpr("g", f"CAST(v AS {kind}) AS v")
    ranks = {f"r{i}": (lambda i: lambda n: F_least(n, i))(i) for i in range(0, 64, 3)}
    wide = K.order_stats(df, by, "v", ranks)
    for cells in (2, 1024):
        counts = df.filter("v IS NOT NULL").groupBy(*by, "v").agg({"v": "count"}).withColumnRenamed("count(v)", "_n")
        narrow = K._narrowed_stats(counts, by, "v", ranks, 5, cells)
        assert sorted(map(str, narrow.select(*wide.columns).collect())) == sorted(map(str, wide.collect()))


def F_least(n, i):
    from pyspark.sql import functions as F

    return F.least(n - 1, F.lit(i).cast("long"))


def test_designed_jobs_change_six_columns(spark):
    jobs = spark.createDataFrame([(1, "S1", "pending", "{}", "m1"), (2, "S1", "pending", "{}", "m2"), (3, "S2", "done", "{}", "m3")], "id long, subject_id string, status string, action_params_json string, motion_path string")
    assigned = spark.createDataFrame(
        [(i, s, 4, 90, f"p{i}", "v", [1.0], f"t{i}", f"b{i}", f"new{i}", [5, 9], 30.0, f"seg{i}") for i, s in ((1, "S1"), (3, "S2"))],
        "id long, subject_id string, subject_action_index int, frame_count int, preset_id string, catalog_version string, trajectory_descriptor array<double>, trajectory_fingerprint string, "
        "blueprint_signature string, source_motion_path string, source_frames array<long>, source_fps double, source_segment_id string",
    )
    rows, events = queue.design_rows(assigned, spark.createDataFrame([(3, 7)], "job_id long, design_seq long"))  # job 3 has a design
    made = rows.first()
    got = {r.id: r for r in queue.designed_jobs(jobs, assigned, rows).collect()}
    assert len(got) == 3 and events.count() == 1
    assert (got[1].recipe, got[1].action_design_id, got[1].action_params_json) == ("expanded_preset", made.action_design_id, made.action_params_json)
    assert (got[1].motion_segment_id, got[1].motion_path, got[1].source_start_frame, got[1].status) == ("seg1", "new1", 5, "pending")
    for i in (2, 3):
        assert (got[i].recipe, got[i].action_design_id, got[i].action_params_json, got[i].motion_path, got[i].source_start_frame) == (None, None, "{}", f"m{i}", None)


def test_code_drift_takes_apart_only_maps_that_differ(spark):
    from cliploom.operators.integrity import hash_drift, hash_map_rows
    from cliploom.operators.provenance import code_drift

    now = {"a.py": "1", "b.py": "2", "c.py": "3"}
    maps = {1: now, 2: {"a.py": "1", "b.py": "x", "c.py": "3"}, 3: {"a.py": "1", "c.py": "3"}, 4: now | {"d.py": "4"}, 5: {}, 6: None, 7: now}
    records = spark.createDataFrame([(k, m, ("s0" if k == 7 else "s1",)) for k, m in maps.items()], "record long, code_files_sha256 map<string,string>, setting_file struct<sha256:string>")
    current = spark.createDataFrame(list(now.items()), "path string, sha256 string")
    got = {(r.record, r.path, r.change) for r in code_drift(records, current, "s1").collect()}
    assert got == {(2, "b.py", "changed"), (3, "b.py", "added"), (4, "d.py", "removed"), (7, "setting", "changed")} | {(k, p, "added") for k in (5, 6) for p in now}
    # the same as comparing every row of every map
    long = hash_map_rows(records, "record", "code_files_sha256")
    every = records.select("record").crossJoin(current)
    assert {(r.record, r.path, r.change) for r in hash_drift(long, every).collect()} == got - {(7, "setting", "changed")}
    assert code_drift(records.limit(0), current).count() == 0 and code_drift(records.filter("record = 1"), current, "s1").count() == 0


def test_close_upward_takes_logarithmic_rounds(spark, monkeypatch):
    from pyspark.sql import functions as F

    pins = []
    pinned = tree.pin
    monkeypatch.setattr(tree, "pin", lambda df: pins.append(1) or pinned(df))
    rng = np.random.default_rng(8)
    rows = [("chain", f"n{i}", f"n{i - 1}" if i else None, i == 4999 or i == 17, i not in (40, 900)) for i in range(5000)]
    rows += [("bush", f"n{i}", f"n{rng.integers(max(0, i - 30), i)}" if i else None, bool(rng.random() < 0.05), bool(rng.random() < 0.9)) for i in range(800)]
    rows += [("bush", "lost", "nowhere", True, True), ("bush", "alone", None, True, False)]
    df = spark.createDataFrame(rows, "rig string, name string, parent string, seed boolean, ok boolean")
    got = {tuple(r) for r in tree.close_upward(df, ["rig"], F.col("seed"), F.col("ok")).collect()}
    known = {(rig, name): (up, ok) for rig, name, up, _, ok in rows}
    expected = set()
    for rig, name, up, seed, _ in rows:
        if seed:
            at = name
            while (rig, at) not in expected:
                expected.add((rig, at))
                up = known[rig, at][0]
                if (rig, up) not in known or not known[rig, up][1]:
                    break
                at = up
    assert got == expected and len(pins) <= 30


def test_rule_editions(spark):
    from cliploom.operators import blueprint as B

    schema = "preset_id string, lower string, torso_channel string, arms string, head string, lower_intensity double, torso_intensity double, arm_intensity double, head_intensity double, stride double, lift double, hip_width_ratio double"
    numbers = (0.9, 0.9, 0.9, 0.9, 0.1, 0.05)
    rows = [("deep", "squat", "bow", "push", "nod", *numbers, 0.10), ("safe", "walk_cycle", "sway", "wave", "nod", *numbers, None), ("none", None, None, None, None, *numbers, 0.10)]
    df = spark.createDataFrame(rows, schema)
    found = {
        e: {r.preset_id: (r.lower, r.torso_channel, r.arms, [round(x, 6) for x in (r.lower_intensity, r.torso_intensity, r.arm_intensity, r.head_intensity, r.stride)], r.compatibility_repairs)
            for r in B.repair_blueprints(df, rules).collect()}
        for e, rules in B.EDITIONS.items()
    }
    start = ["deep_lower_with_flexion->athletic_lean", "deep_lower_caps_forward_reach"]
    stance = "narrow_hip_profile_replaces_deep_lower_with_stable_stance"
    assert found["v3"]["deep"] == ("stable_stance", "neutral", "presentation", [0.0, 0.66, 0.55, 0.9, 0.1], [*start, stance, "narrow_hip_deep_lower_replaces_symmetric_forward_arms"])
    assert found["v4"]["deep"] == ("stable_stance", "neutral", "presentation", [0.0, 0.6996, 0.6264, 0.92, 0.1], [*start, "deep_lower_replaces_crossing_arms", stance])
    assert found["v4-expanded"]["deep"][0] in ("step_touch", "side_step", "heel_tap", "split_stance_rock")
    assert found["v3"]["safe"] == ("walk_cycle", "sway", "wave", [0.9, 0.9, 0.9, 0.9, 0.1], [])
    assert found["v4"]["safe"] == found["v4-expanded"]["safe"] == ("walk_cycle", "sway", "wave", [0.972, 0.94, 0.96, 0.92, 0.106], [])
    assert found["v3"]["none"] == (None, None, None, [0.9, 0.9, 0.9, 0.9, 0.1], [])
    # rules are plain data: two tables of the same rules are equal
    assert B.EDITIONS["v3"][:10] == B.channel_conflicts(B.EARLIER)
