import hashlib
import random
import re
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from shelfrank.llm import repair
from shelfrank.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string, piece long, part string, key string, n string, kind string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "a", "b", "c", "d") for r in rows], SCHEMA)


def every_edit(rows, most_inserts):
    """Least (cost, audit, lines) of all edits, tried one by one. Rows are (role, text, fault)."""
    best = None
    options = []
    for role, text, fault in rows:
        own = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            add = 5 * (fault == "truncated")
            own += [("K", add, (role, text)), ("R", 1 + add, ("user", text)), ("R", 1 + add, ("assistant", text))]
        options.append(own)
    slots = [[i for k in range(most_inserts + 1) for i in product(("user", "assistant"), repeat=k)]] * (len(rows) + 1)
    for edits in product(*options):
        for inserts in product(*slots):
            lines, audit, cost = [], "", 0
            for k, own in enumerate(inserts):
                lines += [(role, "") for role in own]
                audit += "I" * len(own)
                cost += 5 * len(own)
                if k < len(edits):
                    letter, c, line = edits[k]
                    audit += letter
                    cost += c
                    lines += [line] if line else []
            if GOOD.fullmatch("".join(r[:1] or " " for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def plainly(conversations):
    """The result by steps over states, in another form than the search."""
    out = []
    for conv, rows in conversations.items():
        key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest())
        rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=key)
        seen, faults = set(), []
        for _, role, text in rows:
            last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            fault = "blank" if not BLANK.search(text) else "duplicate" if (role, text) in seen else "" if last and last in ".!?" else "truncated"
            faults.append(fault)
            seen.add((role, text))
        best = {"": (0, "", ())}
        wanted = lambda q: "assistant" if q == "u" else "user"

        def insert(best):
            for _ in range(3):
                for q, (c, a, lines) in list(best.items()):
                    w = wanted(q)
                    new = (c + 5, a + "I", (*lines, (w, "")))
                    best[w[0]] = min(new, best.get(w[0], new))
            return best

        for (_, role, text), fault in zip(rows, faults, strict=True):
            after = defaultdict(list)
            for q, (c, a, lines) in insert(dict(best)).items():
                after[q].append((c + 2, a + "D", lines))
                if fault in ("", "truncated"):
                    c += 5 * bool(fault)
                    w = wanted(q)
                    after[w[0]].append((c + 1, a + "R", (*lines, (w, text))))
                    if role[:1] == w[0] or role[:1] == "s" and q == "":
                        after[role[0]].append((c, a + "K", (*lines, (role, text))))
            best = {q: min(x) for q, x in after.items()}
        cost, audit, lines = min(v for q, v in insert(dict(best)).items() if q in ("", "a"))
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:], strict=False)]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum("".join(p) not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def got(df):
    columns = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def some_conversations(seed, convs, most):
    r = random.Random(seed)
    out = defaultdict(list)
    for c in range(convs):
        for t in range(r.randrange(1, most)):
            role = r.choice(["user", "assistant", "system", ["user", "assistant"][t % 2], ["user", "assistant"][t % 2], "tool", "", None])
            text = r.choice(["Fine.", "Fine!", "Why ?  \n", "cut", f"word{r.randrange(99)}.", f"{t} ok.", "", " \t", None, "é。", "x" * 2000 + "."])
            out[c].append((r.choice([t, t, t, t, None, t - 1, 3 * t]), role, text))
            if r.random() < 0.1:
                out[c].append(out[c][-1])
    return out


def test_search_finds_the_cheapest_edits_of_all():
    r = random.Random(5)
    for n in range(60):
        rows = []
        for _ in range(r.randrange(0, 4)):
            rows.append((r.choice(["user", "assistant", "system", "tool"]), "t", r.choice(["", "", "truncated", "blank"])))
        codes = bytes(3 * repair.kind_of(a) + {"": 0, "truncated": 1, "blank": 2}[f] for a, _, f in rows)
        cost, audit, lines = every_edit(rows, 1 if n % 3 else 2)
        assert repair.solve(codes) == (cost, audit)
        mine = repair.edited(audit, repair.START, {i: x[:2] for i, x in enumerate(rows)})
        assert [(a, b) for _, a, b in mine] == lines


def test_segments_chained_agree_with_one_search():
    import pyarrow as pa

    r = random.Random(6)
    for _ in range(150):
        codes = bytes(r.choice([3 * r.randrange(4) + r.randrange(3), 3, 6]) for _ in range(r.randrange(1, 25)))
        cuts = sorted({0, len(codes), *(r.randrange(len(codes)) for _ in range(3))})
        rows = []
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            costs, ranks, audits = repair.solve_segment(codes[a:b])
            rows.append({"part": 0, "seg": k, "costs": costs, "ranks": ranks, "first_kind": codes[a] // 3, "last_kind": codes[b - 1] // 3})
            rows[-1] |= {"first_turn": None, "last_turn": None, "n_turns": 0, "audits": audits}
        found = repair.chain(pa.Table.from_pylist(rows)).to_pylist()
        pairs = [4 * x["entry"] + x["leave"] for x in found]
        audit = "".join(row["audits"][p] + x["tail"] for row, p, x in zip(rows, pairs, found, strict=True))
        cost = sum(row["costs"][p] + 5 * len(x["tail"]) for row, p, x in zip(rows, pairs, found, strict=True))
        assert (cost, audit) == repair.solve(codes)


@pytest.mark.parametrize(("segment", "size"), [(512, 8 << 20), (3, 8 << 20), (50, 3000)])
def test_repair_is_the_plain_one(spark, segment, size):
    conversations = some_conversations(segment, 60, 12)
    conversations[1000] = some_conversations(1, 1, 300)[0]
    conversations[None] = conversations[3] + [(None, None, None)]
    conversations[7777] = [(5, "user", "Said again.")] * 40 + [(6, "assistant", "Yes.")] * 2 + [(8, "user", "Said again.")] * 9
    conversations[-3] = [(None, "user", "No turn.")]
    rows = [(c, *r) for c, own in conversations.items() for r in own]
    random.Random(1).shuffle(rows)
    pieces = repair.repair(frame(spark, rows).repartition(3), segment=segment, segment_bytes=size).cache()
    assert got(repair.digests(pieces)) == plainly(conversations)
    assert pieces.where("n_pieces > 1").count() > (segment < 512)
    turns = repair.repaired_turns(pieces).collect()
    standing = defaultdict(list)
    for t in sorted(turns, key=lambda t: (t.piece, t.place)):
        standing[t.conv_id].append(t.role[:1])
    assert all(GOOD.fullmatch("".join(s)) for s in standing.values()) and {t.edit for t in turns} == {"K", "R"}


def test_lost_conversations_and_empty_tables_have_results(spark):
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    known = frame(spark, [(1, 0, "user", "Hello."), (2, 0, "user", "Hello."), (None, 0, "user", "x")])
    found = got(repair.digests(repair.repair(known.where("conv_id = 1"), known)))
    assert found[1:] == [(2, *none), (None, *none)] and found[0][6:8] == (2, "D")
    empty = known.where("false")
    assert repair.digests(repair.repair(empty)).count() == 0
    assert got(repair.digests(repair.repair(empty, known))) == [(1, *none), (2, *none), (None, *none)]


def test_damage_follows_the_hash(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in (None, 1, 2) for t in (None, *range(40))]
    have = defaultdict(list)
    for r in damaged(frame(spark, rows)).collect():
        have[r.conv_id, r.turn].append((r.role, r.text))
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, "One Two Three")], 3: [(role, text)] * 2, 4: [("user", text)]}
        assert have[conv, turn] == want.get(fault, [(role, text)])


def test_one_conversation_is_read_by_many_tasks(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(4000)] + [(2, 0, "user", "x.")]
    ordered = repair._in_order(frame(spark, rows), frame(spark, rows), 8)
    tasks = [r["count"] for r in ordered.where("conv_id = 1").groupBy("part").count().collect()]
    assert len(tasks) >= 6 and max(tasks) < 3000
    assert ordered.where(F.col("kind") == 0).count() == len(rows)
