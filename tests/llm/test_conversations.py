import random

import duckdb
import pytest

from loadlens.llm import conversations as C


def build(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, part string")


def log(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in range(25):
        n = rnd.randrange(1, 5)
        turns = [("user" if k % 2 == 0 else "assistant", rnd.choice("ab")) for k in range(n)]
        rows += [(conv, k, *t) for k, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_sql_on_whole_turn_lists(spark, seed):
    rows = log(seed)
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = sorted(con.sql(f"select conv_id, part, n_turns, text from ({C.SQL})").fetchall())
    assert sorted(map(tuple, C.render(build(spark, rows)).collect())) == want


def test_snapshots_collapse_and_ties_nulls_repeats(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 5, "assistant", "b"),
            (4, 0, None, None), (4, 0, "user", "<|im_end|>"), (5, None, "user", "z"), (None, 0, "user", "alone")]
    got = {(r.conv_id, r.part): (r.n_turns, r.text) for r in C.render(build(spark, rows)).collect()}
    assert got == {
        (2, 0): (2, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n"),
        (4, 0): (2, "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\n<| im_end| ><|im_end|>\n"),
        (5, 0): (1, "<|im_start|>user\nz<|im_end|>\n"), (None, 0): (1, "<|im_start|>user\nalone<|im_end|>\n")}
    assert C.render(build(spark, [])).count() == 0


def test_long_conversations_are_compared_and_rendered_in_parts(spark):
    long = [(1, k, "user", f"t{k}") for k in range(700)]
    rows = long + [(2, k, "user", f"t{k}") for k in range(600)] + [(3, k, "user", f"t{k}" if k != 300 else "other") for k in range(600)]
    got = sorted((r.conv_id, r.part, r.n_turns) for r in C.render(build(spark, rows)).collect())
    assert got == [(1, 0, 256), (1, 1, 256), (1, 2, 188), (3, 0, 256), (3, 1, 256), (3, 2, 88)]
