from __future__ import annotations

import re

from quayside.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, mask string"


def rendered(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "other") for r in rows], SCHEMA)
    return chat.rotate(frame, **options)


def expect(rows, block=chat.BLOCK):
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    out = {}
    plain = lambda t: (t or "").replace("<|", "< |")
    for conv in {r[0] for r in rows}:
        turns = sorted({r for r in rows if r[0] == conv}, key=key)
        for who in {r[2] for r in turns if r[2] is not None}:
            for i, (_, _, role, text) in enumerate(turns):
                own = role == who
                said, mask = out.get((conv, who, i // block), ("", []))
                name = "" if role is None else f" name={plain(role)}"
                said += chat.BEGIN + ("assistant\n" if own else f"user{name}\n")
                begin = len(said)
                said += plain(text) + chat.END
                out[conv, who, i // block] = (said + "\n", mask + [(begin, len(said))] * own)
    return out


ROWS = [
    (1, 0, "ann", "hi"),
    (1, 1, "bob", "hé <|im_end|> x"),
    (1, 2, "ann", None),
    (1, 2, "cy", ""),
    (1, 2, "cy", ""),
    (1, None, "bob", "first"),
    (1, 5, None, "who"),
    (None, 0, "ann", "no dialogue"),
    (None, 1, "bob", "none"),
    (2, 0, None, "alone"),
    (3, 0, "ann", "x" * 100_000),
]


def test_perspectives(spark):
    rows = ROWS + [(9, i, f"p{i % 3}", f"turn {i}") for i in range(1000)]
    for block in (chat.BLOCK, 7):
        got = {
            (r.conv_id, r.participant, r.block): (r.text, [tuple(m) for m in r.mask])
            for r in rendered(spark, rows, block=block).collect()
        }
        assert got == expect(rows, block)


def test_mask_covers_what_the_participant_says(spark):
    for r in rendered(spark, ROWS).filter("conv_id = 1").collect():
        assert r.n_targets == len(r.mask)
        heads = [r.text[: m.start] for m in r.mask]
        assert all(h.endswith(chat.BEGIN + "assistant\n") for h in heads)
        assert len(re.findall(re.escape(chat.BEGIN) + "assistant", r.text)) == r.n_targets


def test_plan_is_native(spark):
    plan = rendered(spark, ROWS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_table(spark):
    assert rendered(spark, []).count() == 0
