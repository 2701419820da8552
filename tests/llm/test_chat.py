"""Round trips of the chat template."""

import hashlib

from pyspark.sql import functions as F

from linkledger.llm import chat

NASTY = ["", "#", "##", "###", "####", "### user: x", "</turn>", "</turn", "\\", "\\\\", "\\h", "\\l</turn>\n", "a\\###b",
         "</turn></turn>\n### assistant: ", "é😀 ###", ": ", "\n", "\\c:", "x" * 20000]


def back(parts):
    rows = chat.read_back(parts).orderBy("conv_id", "part").collect()
    return {c: [(t.role, t.text) for r in rows if r.conv_id == c for t in r.turns] for c in {r.conv_id for r in rows}}


def test_round_trip(spark):
    roles = ["user", "assistant", "assistant", "system: odd", "a\\b", "### x"]
    rows = [(1, i, roles[i % len(roles)], t) for i, t in enumerate(NASTY)]
    rows += [(2, i * 100, roles[(i // 2) % 2], f"{t}") for i, t in enumerate(NASTY)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = chat.format_parts(df).cache()
    got = back(parts)
    for c in (1, 2):
        assert got[c] == [(r[2], r[3]) for r in rows if r[0] == c]
    one = "".join(r.formatted for r in parts.filter("conv_id = 1").orderBy("part").collect())
    assert one.count("### assistant: ") == sum(
        r[2] == "assistant" and (i == 0 or rows[i - 1][2] != "assistant") for i, r in enumerate(rows[: len(NASTY)]))
    d = {r.conv_id: r for r in chat.digests(parts).collect()}
    assert d[1].n_turns == len(NASTY) and d[1].formatted_chars == len(one)
    assert d[1].loss_chars == sum(len(r[3]) for r in rows if r[0] == 1 and r[2] == "assistant")


def test_nulls_ties_and_empty(spark):
    rows = [(1, None, "user", "n"), (1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"),
            (None, 3, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(9))
    got = back(chat.format_parts(df))
    assert got[1] == [("user", "n"), ("", ""), ("assistant", "b"), ("assistant", "b")]
    assert got[None] == [("user", "x")]
    assert chat.digests(chat.format_parts(df.limit(0))).count() == 0


def test_native(spark):
    df = spark.createDataFrame([(1, 1, "user", "n")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.format_parts(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_runs_across_parts_and_chunks(spark):
    def role(i):
        return "user" if i % 300 < 40 else "assistant"

    rows = [(1, i, role(i), f"t{i}") for i in range(1000)]
    rows += [(2, None, "user", f"{i:04}") for i in range(700)] + [(2, 5, "assistant", "same")] * 600
    rows += [(None, i, "user", "x") for i in range(600)]
    rows += [(3, 255, "user", "a"), (3, 256, "assistant", "b"), (3, 9000, "assistant", "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    parts = chat.format_parts(df).cache()
    made = {}
    for r in parts.orderBy("conv_id", "part", "chunk").collect():
        assert r.formatted.count(chat.TURN_END) <= chat.PART_TURNS
        assert [r.formatted[s.start:s.end] for s in r.loss_spans] == [
            t.split(": ")[-1] for t in r.formatted.split(chat.TURN_END)[:-1]
            if t.split(": ")[-1] in {x[3] for x in rows if x[0] == r.conv_id and x[2] == "assistant"}]
        made[r.conv_id] = made.get(r.conv_id, "") + r.formatted
    d = {r.conv_id: r for r in chat.digests(parts).collect()}
    for c in (1, 2, 3, None):
        own, want, before = [r for r in rows if r[0] == c], "", None
        for _, _, who, text in own:
            want += (f"### {who}: " if who != before else "") + text + chat.TURN_END
            before = who
        assert made[c] == want and d[c].formatted_chars == len(want) and d[c].n_turns == len(own)
        said = "".join(f"{r[2]}\n{r[3]}\n" for r in own)
        assert d[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
