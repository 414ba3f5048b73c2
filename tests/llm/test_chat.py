from tidemark.llm.chat import format_chats

SCHEMA = "conv_id long, turn long, role string, text string, conv string, rank int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows):
    convs = {}
    for c, k, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((k is not None, k or 0, role or "", text or ""))
    convs = {c: tuple(f"<|im_start|>{r}\n{t}<|im_end|>\n" for *_, r, t in sorted(v)) for c, v in convs.items()}
    out = []
    for c, v in convs.items():
        same = [d for d, w in convs.items() if w == v]
        if c == min(same) and not any(len(w) > len(v) and w[:len(v)] == v for w in convs.values()):
            out.append((c, len(v), len(same), "".join(v)))
    return sorted(out)


def turns(c, texts, start=0):
    return [(c, start + i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_matches_brute_force(spark):
    rows = []
    for c in range(1, 8):  # snapshots after each turn
        rows += turns(c, ["hi", "yes", "ask", "tell", "more", "fine", "bye"][:c])
    rows += turns(20, ["hi", "no"]) + turns(21, ["hi"]) + turns(22, ["hi", "yes", "ASK"]) + turns(30, ["x"] * 700)
    rows += turns(31, ["x"] * 300) + turns(32, ["x"] * 699 + ["y"]) + turns(40, ["dup", "b"]) + turns(41, ["dup", "b"])
    rows += [(50, 0, None, None), (51, 0, "", ""), (52, None, "user", "n"), (52, 1, "user", "m"), (None, 0, "user", "q"),
             (53, 0, "user", "rep"), (53, 0, "user", "rep"), (54, 0, "user", "rep"), (55, 0, "userrep", "")]
    for chunk in (256, 3):
        got = format_chats(make(spark, rows), chunk_turns=chunk).collect()
        assert sorted((r.conv_id, r.n_turns, r.n_copies, r.chat) for r in got) == brute(rows)


def test_empty_table_and_native_plan(spark):
    out = format_chats(make(spark, []))
    assert out.count() == 0
    assert "Python" not in out._jdf.queryExecution().toString()
