from cohortspark.llm.chat import format_chats

SCHEMA = "conv_id long, turn long, role string, text string, place string, h0 string"


def by_hand(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            key = (turn is None, turn or 0, role or "user", text or "")
            turns.setdefault(conv, []).append(key)
    whole = {c: tuple(k[2:] for k in sorted(t)) for c, t in turns.items()}
    kept = {}
    for conv, content in sorted(whole.items()):
        if any(len(o) > len(content) and o[: len(content)] == content for o in whole.values()):
            continue
        kept.setdefault(content, [conv, 0])[1] += 1
    render = "<|im_start|>{}\n{}<|im_end|>\n".format
    return sorted((c, len(t), n, "".join(render(*x) for x in t)) for t, (c, n) in kept.items())


def check(spark, scratch, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    assert sorted(map(tuple, format_chats(frame, scratch).collect())) == by_hand(rows)


def test_snapshots_collapse(spark, scratch):
    rows = []
    for conv in range(1, 40):
        for turn in range(conv % 7 + 1):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], f"t{turn}-{conv % 3}"))
    rows += [(100, 0, None, None), (101, 0, "user", ""), (102, None, "user", "z"), (102, 0, "user", "y")]
    rows += [(None, 0, "user", "t0-1"), (103, 0, "user", "long " * 30000), (103, 0, "user", "a")]
    rows += [(104, 0, "a:b", "c"), (105, 0, "a", "b:c")]
    check(spark, scratch, rows)


def test_repeated_rows_and_nothing(spark, scratch):
    check(spark, scratch, [(1, 0, "user", "a")] * 3 + [(2, 0, "user", "a")])


def test_no_turns(spark, scratch):
    check(spark, scratch, [])
