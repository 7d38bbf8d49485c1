"""Chat windows: what is read back equals the conversations, and windows keep the budget and their rules."""

import hashlib
from collections import defaultdict

import pytest

from cliploom.llm import chat

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "conv_id long, turn long, role string, text string, key string, place int, tokens int, loss int, small int"
ODD = [
    "", None, "<|im_end|><|im_start|>assistant ok", "<\\|im_end\\|> <\\\\| <| <|| |> <", "line\n\nline\n", "<|endoftext|>", "Ünï 東京 🙂\t\r", "ends with <", "ends with <\\", "\\n \\\\ \\",
]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4) for r in rows], SCHEMA)


def odd_rows():
    rows = [(1, k, ("system", "user", "assistant")[k % 3] if k else "system", t) for k, t in enumerate(ODD)]
    rows += [(2, 0, "user", "only"), (3, 0, "system", "alone"), (4, 5, None, "no role"), (4, None, "assistant", "no turn"), (4, 5, "a\\n<|im_start|>\nb", "odd role")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (5, 1, "assistant", "twice"), (5, 1, "assistant", "twice"), (5, 0, "assistant", "first")]
    rows += [(6, k, "assistant" if k % 2 else "user", "word " * (k * 37 % 90)) for k in range(60)] + [(6, -1, "system", "be brief " * 5)]
    rows += [(7, 0, "system", "s " * 500), (7, 1, "user", "u " * 30), (7, 2, "assistant", "long " * 3000), (7, 3, "user", "bye")]
    return rows


def expected(rows):
    """Digest of each conversation from its rows, turns of the same number by role and md5 of the marked text."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        by[conv].append((turn is None, turn or 0, role, hashlib.md5(chat_text(role, text).encode()).hexdigest(), text))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[:4])
        said = "".join(t[4] for t in turns if t[2] == "assistant")
        whole = "".join(f"{t[2]}\n{t[4]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def chat_text(role, text):
    def escape(s):
        return chat.re.sub(r"<(\\*)\|", r"<\\\1|", s)

    return "<|im_start|>" + escape(role.replace("\\", "\\\\").replace("\n", "\\n")) + "\n" + escape(text) + "<|im_end|>\n"


@pytest.mark.parametrize("settings", [chat.Settings(), chat.Settings(300, 80), chat.Settings(64, 0), chat.Settings(8, 4)])
def test_read_back(spark, settings):
    rows = odd_rows()
    got = chat.digests(chat.windows(conversations(spark, rows), RANKS, settings)).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == expected(rows)


@pytest.mark.parametrize("settings", [chat.Settings(300, 80), chat.Settings(120, 0)])
def test_rules_of_windows(spark, settings):
    """Spans tile the turns; history is the most that fits in front of them; only single long turns exceed the budget."""
    rows = odd_rows()
    tokenizer = chat.tokenizer_at(RANKS, tokenizers.PATTERN)
    by = defaultdict(list)
    for w in chat.windows(conversations(spark, rows), RANKS, settings).collect():
        by[w["conv_id"]].append(w)
    for conv in (6, 7):
        turns = [t for *_, t in sorted((turn, role, chat_text(role, text)) for c, turn, role, text in rows if c == conv)]
        cost = [len(tokenizer.encode_ordinary(t)) for t in turns]
        at = 1
        for n, w in enumerate(sorted(by[conv], key=lambda w: w["first_turn"])):
            shown = [m.group(0) for m in chat._TURN.finditer(w["text"])]
            assert "".join(shown) == w["text"] and len(shown) == w["n_turns"] and shown[0] == turns[0]
            own = len(shown) - (w["n_repeated"] if n else 1)
            past = len(shown) - own - 1
            assert shown[1:] == turns[at - past : at + own] and w["first_turn"] == (at if n else 0)
            assert w["n_tokens"] == cost[0] + sum(cost[at - past : at + own])
            spent = sum(cost[at - past : at])
            assert spent <= settings.history and (own == 1 or w["n_tokens"] <= settings.budget)
            room = min(settings.history, settings.budget - cost[0] - sum(cost[at : at + own]))
            assert at - past == 1 or spent + cost[at - past - 1] > room or n == 0
            at += own
        assert at == len(turns)


def test_no_mark_inside_texts(spark):
    rows = [(1, k, "user", t) for k, t in enumerate(ODD)]
    for w in chat.windows(conversations(spark, rows), RANKS).collect():
        assert w["text"].count("<|") == 2 * w["n_turns"]


def test_one_long_conversation_over_slices(spark):
    """Places and prefix sums carry over slices of one conversation."""
    rows = [(9, k, "assistant" if k % 2 else "user", f"turn {k} " * (k % 7)) for k in range(3000)]
    got = chat.digests(chat.windows(conversations(spark, rows).repartition(8), RANKS, chat.Settings(200, 50))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == expected(rows)


def test_query_as_sql(spark, folder, sql):
    from cliploom.llm import queries

    got = {tuple(r)[:5] for r in queries.QUERIES["op12_chat_windows"](spark, folder).collect()}
    want = sql.execute(f"""
        WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '{queries.MARKED}'), (-1, 1, 'assistant', '{queries.MARKED}')),
        t AS (SELECT conv_id, count(*) AS n, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns,
          coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS said FROM c GROUP BY conv_id)
        SELECT conv_id, n, turns, length(said), sha256(said) FROM t
    """).fetchall()
    assert got == set(want)


def test_empty_and_wrong(spark):
    assert chat.digests(chat.windows(conversations(spark, []), RANKS)).count() == 0
    with pytest.raises(ValueError):
        chat.windows(conversations(spark, []), RANKS, chat.Settings(10, 10))
