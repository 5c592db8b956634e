"""op5 against brute force over random nested quotes."""

import random
import re

from vitalair.llm import q05_chats as q5

SCHEMA = "conv_id long, turn long, role string, text string"


def parsed(text):
    out = []
    for x in re.split("\r?\n", text or ""):
        mark = re.match(q5.MARK, x)
        body = " ".join((x[mark.end() :] if mark else x).split()).lower()
        if body:
            out.append((mark[0].count(">") if mark else 0, body))
    return out


def brute(rows):
    """(conv, turn) -> (from conv, from turn, number of quoted lines with a source), and (conv, turn) -> text without those lines."""
    own = {}
    for conv, turn, _, text in rows:
        own.setdefault((conv, turn), []).append([b for level, b in parsed(text) if not level])

    def holds(place, want):
        return any(o[i : i + len(want)] == want for o in own[place] for i in range(len(o) - len(want) + 1))

    cache, out, texts = {}, {}, {}
    for conv, turn, _, text in rows:
        lines, quotes = parsed(text), set()
        for i, (level, body) in enumerate(lines):
            if level:
                quotes.add((level, (body,)))
                if not i or lines[i - 1][0] != level:
                    j = i
                    while j < len(lines) and lines[j][0] == level:
                        j += 1
                    quotes.add((level, tuple(b for _, b in lines[i:j])))
        best, n, gone = None, 0, set()
        for level, want in quotes:
            if want not in cache:
                cache[want] = sorted(p for p in own if holds(p, list(want)))
            near = [t for c, t in cache[want] if c == conv and t < turn]
            far = [p for p in cache[want] if p[0] != conv]
            if near or far:
                rank = (0, level, -len(want), -near[-1], conv) if near else (1, level, -len(want), -far[0][1], far[0][0])
                best = min(best or rank, rank)
                n += len(want) == 1
                gone |= set(want) if len(want) == 1 else set()
        if best:
            out[conv, turn] = (best[4], -best[3], n)
        kept = []
        for x in re.split("\r?\n", text or ""):
            said = parsed(x)
            quoted = re.match(q5.MARK, x)
            if not (quoted and (not said or said[0][1] in gone)):
                kept.append(x)
        texts[conv, turn] = "\n".join(kept).strip(" ") if gone else text
    return out, texts


def test_random_nested_quotes(spark):
    rng = random.Random(12)
    rows = []
    for conv in range(250):
        said = []
        for turn in range(rng.randint(3, 18)):
            lines = []
            for _ in range(rng.randint(0, 2)):
                if said and rng.random() < 0.8:
                    source = rng.choice(said).split("\n")
                    a = rng.randrange(len(source))
                    lines += [("> " if rng.random() < 0.5 else ">") + x for x in source[a : a + rng.randint(1, 9)]]
            if rng.random() < 0.15:
                lines += [f"> said nowhere {rng.randrange(9)}", ">> > nor this", ">"][: rng.randint(1, 3)]
            lines += [rng.choice(["yes", "Thanks  a lot", "no"]) if rng.random() < 0.2 else f"line {rng.randrange(400)} {rng.randrange(3)}" for _ in range(rng.randint(1, 9))]
            said.append("\n".join(lines))
            rows.append((conv, turn, "user", said[-1]))
    want, texts = brute(rows)
    assert len(rows) > 2000 and len(want) > 800
    got = q5.reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn, r.n_quotes) for r in got if r.reply_conv is not None} == want
    places = {}
    for r in got:
        places.setdefault((r.conv_id, r.root_turn), []).append((r.turn, r.place))
        assert r.text == texts[r.conv_id, r.turn]
        if r.reply_conv == r.conv_id:
            assert r.root_turn <= r.reply_turn < r.turn
    assert all([p for _, p in sorted(own)] == list(range(len(own))) for own in places.values())


def test_quotes_without_a_source_stay(spark):
    text = "Please run:\n>>> print(1)\n> to be or not to be\nthat is Shakespeare"
    rows = [(1, 0, "user", text), (2, 0, "user", "print(2)"), (2, 1, "user", "> print(2)\n>\n> and more\n\nworks"), (3, 0, "user", "> only this"), (3, 1, "user", "only this"), (3, 2, "user", ">only this")]
    got = {(r.conv_id, r.turn): r.text for r in q5.reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 0): text, (2, 0): "print(2)", (2, 1): "> and more\n\nworks", (3, 0): "> only this", (3, 1): "only this", (3, 2): ""}


def test_a_line_that_two_conversations_hold(spark):
    rows = [(1, 0, "user", "> shared words\nmine"), (1, 5, "user", "shared words"), (2, 0, "user", "Shared  words")]
    got = {(r.conv_id, r.turn): (r.reply_conv, r.reply_turn) for r in q5.reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, 0): (2, 0), (1, 5): (None, None), (2, 0): (None, None)}


def test_very_long_messages(spark):
    text = "\n".join(f"sentence {i} of many" for i in range(30_000))
    rows = [(1, 0, "user", text), (1, 1, "user", text.replace("sentence 7 ", "other 7 ")), (1, 2, "user", "\n".join("> " + x for x in text.split("\n")) + "\nagreed")]
    got = {r.turn: (r.reply_turn, r.text, r.n_quotes) for r in q5.reply_ordered(spark.createDataFrame(rows, SCHEMA)).collect() if r.turn == 2}
    assert got == {2: (0, "agreed", 30_000)}
