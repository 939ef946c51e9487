import hashlib
import re
import zlib
from itertools import product

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stowage.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults_of(rows):
    """Rows (role, text) with their first fault."""
    seen, out = set(), []
    for role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        if not shown:
            fault = cr.BLANK
        elif (role, text) in seen:
            fault = cr.DUPLICATE
        else:
            fault = cr.SOUND if shown[-1] in ".!?" else cr.CUT
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def cheapest(rows):
    """Best (cost, audit, lines) by trying every edit of every row and up to three inserts anywhere."""
    paths = {(0, "", ""): ()}  # (cost, audit, roles so far) -> lines

    def with_inserts(paths):
        out = dict(paths)
        for _ in range(3):
            for (cost, audit, roles), lines in list(out.items()):
                for role in ("user", "assistant"):
                    out.setdefault((cost + 3, audit + "I", roles + role[0]), (*lines, f"{role}:"))
        return {k: v for k, v in out.items() if re.match(r"s?(ua)*u?\Z", k[2])}

    for role, text, fault in rows:
        after = {}
        for (cost, audit, roles), lines in with_inserts(paths).items():
            ways = [(4, "D", None, None)]
            if fault in (cr.SOUND, cr.CUT):
                more = 3 * (fault == cr.CUT)
                ways += [(more, "K", role[:1] or "?", f"{role}:{text}")]
                ways += [(3 + more, "R", r[0], f"{r}:{text}") for r in ("user", "assistant")]
            for c, edit, initial, line in ways:
                to = roles + (initial if edit != "D" else "")
                if re.match(r"s?(ua)*u?\Z", to):
                    after.setdefault((cost + c, audit + edit, to), lines if edit == "D" else (*lines, line))
        # Of paths that end in the same state only the best can matter; their roles' state is what counts.
        best = {}
        for (cost, audit, roles), lines in after.items():
            state = (roles == "", roles == "s", roles[-1:])
            if state not in best or (cost, audit) < best[state][0][:2]:
                best[state] = ((cost, audit, roles), lines)
        paths = dict(best.values())
    ends = {k: v for k, v in with_inserts(paths).items() if GOOD.match(k[2])}
    (cost, audit, _), lines = min(ends.items())
    return cost, audit, "\n".join(lines)


def by_hand(rows, hurt=True):
    """One row of results for each conversation."""
    out = []
    all_rows = damaged(rows) if hurt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in all_rows if r[0] == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        marked = faults_of([r[1:] for r in mine])
        turns = [r[0] for r in mine if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:], strict=False)]
        cost, audit, text = cheapest(marked)
        faults = [sum(f == k for *_, f in marked) for k in (cr.BLANK, cr.DUPLICATE, cr.CUT)]
        out.append((conv, gaps, *faults, sum(p not in cr.PAIRS for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def audits(frame):
    rows = cr.digest_repairs(cr.repair_conversations(frame)).collect()
    return sorted(((None if r[0] is None else int(r[0]), *r[1:]) for r in rows), key=str)


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, conv string, fault string, edits long, stats int, turn_key int, kind int, nth int"
    return spark.createDataFrame([(*r, "x", "y", 1, 2, 3, 4, 5) for r in rows], schema)


TEXTS = ["Yes.", "No!  ", "why", "", " \n", None, "Yes.", "long " * 2000 + ".", "a.b", "é?"]
ROLES = ["user", "assistant", "system", None, "", "tool"]


def test_repairs_are_the_cheapest(spark):
    rows = [(c, t, ROLES[(c * 7 + t * t) % 6 if c % 3 else t % 2], TEXTS[(c * 3 + t) % 10]) for c in range(60) for t in range(c % 7)]
    rows += [(None, 0, "user", "Hi."), (None, None, "assistant", "Yo."), (99, None, "user", "A."), (99, None, "user", "A."), (99, 5, None, None)]
    rows += [(98, 3, "assistant", "B."), (98, 3, "user", "A."), (98, 3, "user", "A."), (98, 2**62, "user", "A.")]
    assert audits(cr.damage(frame(spark, rows))) == by_hand(rows)
    assert audits(frame(spark, rows)) == by_hand(rows, hurt=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "x"]), st.sampled_from([cr.SOUND, cr.BLANK, cr.DUPLICATE, cr.CUT])), max_size=7))
def test_the_recurrence_gives_the_least_audit(rows):
    marked = [(role, f"t{i}", fault) for i, (role, fault) in enumerate(rows)]
    light = pd.DataFrame([("c", str(i), r, "k", r[:1], f) for i, (r, _, f) in reversed(list(enumerate(marked)))],
                         columns=["conv", "turn", "role", "text_key", "initial", "fault"])
    if not len(light):
        return
    plan = pd.concat([p for p in cr._plan(iter([light[:3], light[3:]])) if len(p)])
    opening = plan[plan["stats"].notna()].iloc[0]
    blocks = [(None, None, e, None) for e in plan["edits"].tolist()[::-1] if isinstance(e, bytes)]
    stream = pd.DataFrame([("c", None, None, None, opening["stats"])] + [("c", *b) for b in blocks] + [("c", r, t, None, None) for r, t, _ in marked],
                          columns=["conv", "role", "text", "edits", "stats"])
    got = pd.concat(list(cr._digest(cr._apply(iter([stream[:2], stream[2:]])))))
    cost, audit, text = cheapest(marked)
    assert (got["cost"].iloc[0], got["audit"].iloc[0]) == (cost, audit)
    assert got["repaired_sha256"].iloc[0] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("block", [1, 2, 3])
def test_blocks_of_any_size_give_the_same(block):
    """A conversation longer than a block leaves its edits in several; equal rows may lie at a seam."""
    rows = [("c", 0 if i < 4 else i, "user" if i % 2 == 0 or i < 4 else "assistant", "A." if i < 4 else f"t{i}.") for i in range(9)]
    marked = faults_of([r[2:] for r in rows])
    light = pd.DataFrame([("c", str(r[1]), r[2], r[3], r[2][:1], f) for r, (*_, f) in zip(reversed(rows), reversed(marked), strict=True)],
                         columns=["conv", "turn", "role", "text_key", "initial", "fault"])
    before = cr.BLOCK_ROWS
    cr.BLOCK_ROWS = block
    try:
        plan = pd.concat(list(cr._plan(iter([light]))))
    finally:
        cr.BLOCK_ROWS = before
    mixed = [((-1, "", "", 0, 0), ("c", None, None, None, plan[plan["stats"].notna()].iloc[0]["stats"]))]
    for p in plan[plan["stats"].isna()].itertuples():
        assert len(p.edits) <= block
        mixed.append(((int(p.turn_key), p.role_key, p.text_key, 0, -p.to_end), ("c", None, None, p.edits, None)))
    mixed += [((r[1], r[2], r[3], 1, 0), ("c", r[2], r[3], None, None)) for r in rows]
    stream = pd.DataFrame([m[1] for m in sorted(mixed, key=lambda m: m[0])], columns=["conv", "role", "text", "edits", "stats"])
    got = pd.concat(list(cr._digest(cr._apply(iter([stream])))))
    assert (got["cost"].iloc[0], got["audit"].iloc[0]) == cheapest(marked)[:2]


def test_a_giant_conversation_streams(spark):
    """Many batches and blocks, with odd conversations around."""
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"line {t}.") for t in range(150_000)] + [(4, 0, "user", "A."), (6, 0, "assistant", "B.")]
    got = {r[0]: r for r in audits(frame_of(spark, rows))}
    text = "\n".join(f"{r}:{x}" for c, _, r, x in rows if c == 5)
    assert got[5] == (5, 0, 0, 0, 0, 0, 0, "K" * 150_000, hashlib.sha256(text.encode()).hexdigest())
    assert got[4][7] == "KI" and got[6][6:8] == (3, "IK")


def frame_of(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]))


def test_repaired_rows_follow_one_another(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "assistant", "Hi."), (2, 0, "user", "")]
    got = [tuple(r)[:4] for r in cr.repair_conversations(frame(spark, rows)).collect()]
    assert sorted(got, key=lambda r: r[0]) == [
        ("1", None, None, None), ("1", "R", "user", "Hello."), ("1", "K", "assistant", "Hi."),
        ("2", None, None, None), ("2", "D", None, None),
    ]
    assert audits(frame(spark, rows)) == by_hand(rows, hurt=False)


def test_an_empty_table(spark):
    assert audits(frame(spark, [])) == []
    assert audits(cr.damage(frame(spark, []))) == []


def test_every_case_of_a_row():
    """The costs ahead differ by so little that few cases are ever remembered."""
    steps, todo, seen = cr.Steps(), [cr.AT_END], set()
    while todo:
        ahead = todo.pop()
        if ahead in seen:
            continue
        seen.add(ahead)
        todo += [steps(ahead, i, f)[2] for i, f in product(["s", "u", "a", "x"], range(4))]
    assert len(seen) < 200
