import hashlib

from compare import compare, duck
from helpers import rows

from conftest import SF001
from ledgerloom.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


def slow_fold(events):
    """Messages of one conversation's events, one event after another."""
    said = {}
    for _, msg, kind, role, text in sorted(events, key=lambda e: (e[0], e[2])):
        if kind == "regenerate":
            said = {m: x for m, x in said.items() if m <= msg}
        at = said.setdefault(msg, [None, ""])
        at[0] = role if role is not None else at[0]
        at[1] = text or "" if kind == "edit" else "" if kind == "regenerate" else at[1] + (text or "") if kind == "delta" else at[1]
    return sorted((m, r, t) for m, (r, t) in said.items())


def test_fold_against_a_plain_loop(spark):
    told = {
        1: [(1, 1, "open", "user", None), (2, 1, "delta", None, "he"), (3, 1, "delta", None, "llo"), (4, 2, "open", "assistant", None), (5, 2, "delta", None, "bad"),
            (6, 2, "regenerate", None, None), (7, 2, "delta", None, "good"), (8, 1, "edit", None, "hi")],
        2: [(1, 1, "delta", "user", "a"), (2, 2, "delta", "assistant", "b"), (3, 3, "delta", "user", "c"), (4, 4, "delta", "assistant", "d"),
            (5, 2, "regenerate", None, None), (6, 2, "delta", None, "B"), (7, 3, "delta", "user", "C"), (8, 3, "edit", None, "E"), (9, 3, "delta", None, "!")],
        3: [(1, 1, "edit", "user", None), (2, 1, "delta", None, None)],
    }
    events = spark.createDataFrame([(c, s, m, k, r, t) for c, e in told.items() for s, m, k, r, t in e], chat.EVENTS)
    got = {}
    for r in chat.fold(events).collect():
        got.setdefault(r.conv_id, []).append((r.msg, r.role, r.text))
    assert {c: sorted(m) for c, m in got.items()} == {c: slow_fold(e) for c, e in told.items()}
    assert chat.fold(events.limit(0)).isEmpty()


def test_round_trip_of_hostile_texts(spark):
    hostile = [
        chat.PROBE_TEXT, "<|im_start|>", "<|im_sep|>", "\\<|", "<\\|im_end|>", "\\", "\\\\", "<", "|", "<|", "<<||>>", "", "\n\n", "é\\n😀", "a" * 100_000, "$1 \\1",
    ]
    data = [(1, k, ("user", "assistant", "<|im_sep|>\\ \n")[k % 3], t) for k, t in enumerate(hostile)]
    (got,) = chat.read_back(chat.format_conversations(spark.createDataFrame(data, ROWS))).collect()
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in data]
    assert got.loss_text == "".join(t for _, _, r, t in data if r == "assistant")
    assert got.formatted.count(chat.START) == got.formatted.count(chat.END) == got.formatted.count(chat.SEP) == len(data)


def test_edge_cases(spark):
    data = [(1, 2, "assistant", "b"), (1, 1, "user", None), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"), (None, None, None, None), (None, 1, "user", "x"), (3, None, "assistant", "")]
    got = chat.digest(chat.format_conversations(spark.createDataFrame(data, ROWS)))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    by = {r.conv_id: r for r in got.collect()}
    assert by[1].turns_sha256 == sha("user\n\nassistant\na\nassistant\nb\nassistant\nb\n") and by[1].n_turns == 4
    assert by[1].loss_sha256 == sha("abb") and by[1].loss_chars == 3
    assert by[None].turns_sha256 == sha("\n\nuser\nx\n") and by[3].loss_chars == 0
    assert rows(chat.digest(chat.format_conversations(spark.createDataFrame([], ROWS)))) == []


def test_query_against_sql(spark):
    table = spark.read.parquet(f"{SF001}/conversations.parquet")
    ok, said = compare(chat.digest(chat.format_conversations(chat.with_probe(spark, table))), duck(SF001), chat.ORACLE)
    assert ok, said


def test_only_built_in_functions(spark, capsys):
    table = spark.read.parquet(f"{SF001}/conversations.parquet")
    chat.digest(chat.format_conversations(chat.with_probe(spark, table))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
