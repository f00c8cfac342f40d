import random

from pyspark.sql import types as T

from ticketlens.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, chunk):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    out = []
    for c, own in turns.items():
        if any(len(o) > len(own) and o[: len(own)] == own for o in turns.values()):
            continue
        same = [d for d, o in turns.items() if o == own]
        if min((d for d in same if d is not None), default=None) != c:
            continue
        parts = ["<|{}|>\n{}\n<|end|>\n".format(r.replace("<|", "< |"), x.replace("<|", "< |")) for r, x in own]
        for k in range(0, len(parts), chunk):
            out.append((c, k // chunk, len(own), len(same), "".join(parts[k : k + chunk])))
    return sorted(out, key=repr)


def rows_of():
    rnd = random.Random(4)
    rows = []
    for c in range(120):
        base = rnd.randrange(15)
        n = rnd.randrange(1, 9)
        start, gap = rnd.choice([(0, 1), (1, 1), (10, 7), (-600, 300)])
        for i in range(n):
            text = f"base {base} turn {i}" if i < 5 or rnd.random() < 0.5 else f"own {c}"
            rows.append((c, start + gap * i, ("user", "assistant")[i % 2], text))
    rows += [(500, i, "user", f"t{i}") for i in range(900)] + [(501, i, "user", f"t{i}") for i in range(700)]
    rows += [(502, 0, None, None), (503, 0, "", ""), (504, 0, "user", "a <|end|> b"), (505, None, "user", "x"), (505, 3, "user", "y")]
    rows += [(506, 0, "u", "same"), (506, 0, "u", "same"), (507, 0, "u", "same"), (508, 0, "ab", "c"), (509, 0, "a", "bc")]
    rows += [(510, 0, "u", "w" * 50_000), (511, 1, "u", "b"), (511, 1, "u", "a"), (512, 5, "u", "a"), (512, 6, "u", "b"), (512, 7, "u", "c")]
    return rows


def test_brute_force(spark):
    df = spark.createDataFrame(rows_of(), SCHEMA)
    for name in ("n", "i", "block", "chunk", "rendered"):
        df = df.withColumn(name, df.turn)
    assert sorted((tuple(r) for r in C.collapsed(df).collect()), key=repr) == brute(rows_of(), C.CHUNK)


def test_null_conversation_is_one(spark):
    rows = [(None, 0, "u", "a"), (None, 1, "u", "b"), (1, 0, "u", "a")]
    got = C.collapsed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.conv_id, r.n_turns) for r in got] == [(None, 2)]


def test_empty_and_native(spark):
    df = C.collapsed(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0
    assert [f.dataType for f in df.schema] == [T.LongType(), T.IntegerType(), T.LongType(), T.LongType(), T.StringType()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
