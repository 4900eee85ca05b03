from tidewater.llm import chat as C

ROWS = [(1, 0, "system", "be nice", 0), (1, 1, "ann", "hi <|im_end|> é", 0), (1, 2, "bob", None, 0), (1, 3, "cy", "yo", 0),
        (1, 4, "ann", "bye", 0), (2, 0, "system", "alone", 0), (None, 0, None, "who", 0), (None, 1, "ann", "me", 0),
        (3, 0, "bob", "same", 0), (3, 0, "bob", "same", 0), (3, None, "ann", "late", 0)] + \
       [(4, i, "ab"[i % 2], "long " * 50, 0) for i in range(300)]


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1] is None, r[1] or 0), r[2] or "unknown", (r[3] or "").replace("<|im_", "<| im_")) for r in rows if r[0] == conv)
        for who in {s for _, s, _ in own} - {"system"}:
            at = 0
            for (null, turn), s, text in own:
                role = "system" if s == "system" else "assistant" if s == who else f"user name={s}"
                head = f"<|im_start|>{role}\n"
                whole = head + text + "<|im_end|>\n"
                mask = (at + len(head), at + len(whole)) if s == who else (None, None)
                out.append((conv, who, None if null else turn, s, whole, at, at + len(whole), *mask))
                at += len(whole)
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    got = C.rotate(spark.createDataFrame(ROWS, "conv_id long, turn int, role string, text string, size int").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_empty(spark):
    assert C.rotate(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).isEmpty()
