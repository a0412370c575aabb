import hashlib
import random
import zlib

import pytest

from mentionlake.llm import auction, conversations

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
BLANKS = " \t\n\x0b\x0c\r"


def cheapest(codes, arcs=auction):
    """(cost, letters) by going back from the end, state by state."""
    best = None
    for at in range(len(codes), -1, -1):
        here = {}
        for q in range(4):
            found = [(0, "")] if at == len(codes) and q in (0, 3) else []
            if at < len(codes):
                code = codes[at]
                more = 3 if code.isupper() else 0
                found.append((4 + best[q][0], "D" + best[q][1]))
                if code != "d":
                    kept = arcs.KEPT.get((q, code.lower()))
                    if kept is not None:
                        found.append((more + best[kept][0], "K" + best[kept][1]))
                    to = arcs.NEXT[q]
                    found.append((3 + more + best[to][0], "R" + best[to][1]))
            here[q] = min(found, default=(10**9, ""))
        for _ in range(4):
            for q in range(4):
                cost, letters = here[arcs.NEXT[q]]
                here[q] = min(here[q], (3 + cost, "I" + letters)) if cost < 10**9 else here[q]
        best = here
    return best[0]


def expected(rows):
    """The result for each conv_id, row by row in plain Python."""
    groups = {}
    for conv, turn, role, text, *_ in rows:
        left = groups.setdefault(conv, [])
        show = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        role, text = "user" if kind == 4 else show[2], show[3]
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        left.extend([(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1))
    out = {}
    for conv, left in groups.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes, count = set(), "", dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        for i, (_, role, text) in enumerate(left):
            initial, solid = role[:1], text.rstrip(BLANKS)
            code = initial if initial in ("s", "u", "a") else "x"
            if not solid:
                count["blank"] += 1
                code = "d"
            elif (role, text) in seen:
                count["duplicate"] += 1
                code = "d"
            elif solid[-1] not in ".!?":
                count["truncated"] += 1
                code = code.upper()
            seen.add((role, text))
            codes += code
            count["illegal"] += i > 0 and left[i - 1][1][:1] + initial not in ("su", "ua", "au")
        cost, letters = cheapest(codes)
        lines, state, at = [], 0, 0
        for letter in letters:
            _, role, text = left[at] if letter != "I" else (None, None, "")
            at += letter != "I"
            if letter == "D":
                continue
            state = auction.KEPT[state, role[:1]] if letter == "K" else auction.NEXT[state]
            lines.append(f"{role if letter == 'K' else 'user' if state == 2 else 'assistant'}:{text}")
        turns = [t for t, _, _ in left if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *count.values(), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(spark, rows):
    found = conversations.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in found}
    assert len(found) == len(got)
    assert got == expected(rows)
    return got


@pytest.mark.parametrize("block", [1, 3, 32])
def test_auction_finds_the_least_of_the_cheapest(monkeypatch, block):
    monkeypatch.setattr(auction, "BLOCK", block)
    random.seed(block)
    for n in [0, 1, 2, 3, 4, 5, 6, 8, 13, 40] * 12:
        codes = "".join(random.choice("dsuaxSUAX") for _ in range(n))
        letters, _ = auction.trace(codes, None, frozenset([auction.START]))
        assert (auction.cost(codes, letters), letters) == cheapest(codes)


def test_prices_are_at_most_every_arc_and_tight_on_the_path():
    arcs = auction._arcs("uUadxsA", None)
    prices = [0] * len(arcs)
    auction.auction(arcs, prices, 0)
    assert prices[0] == cheapest("uUadxsA")[0]
    assert all(prices[i] <= cost + prices[j] for i, out in enumerate(arcs) for _, cost, j in out)


def test_against_brute_force(spark):
    random.seed(5)
    texts = ["Yes.", "No", "Why?", "", " \t", "so on ", "end!\n", None, "a" * 50_000, "é.", "\x85"]
    rows = []
    for conv in range(60):
        for turn in range(random.randrange(0, 12)):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, random.choice([turn, turn, turn, turn + 1, None]), role, random.choice(texts), "clash"))
    rows += rows[::7] + [(None, 1, "user", "Hello.", None), (None, None, None, None, None), (7_000_000_000_000_000_001, 3, "assistant", "Only", None)]
    check(spark, rows)


def test_a_conversation_over_many_partitions(spark):
    random.seed(6)
    rows = [(1, t, random.choice(["user", "assistant"]), random.choice([f"Text {t}.", f"Text {t}", "Same.", ""]), None) for t in range(700)]
    rows += [(1, 5, "user", "Copy.", None)] * 150 + [(c, t, "ua"[t % 2] + "x", f"{c}.", None) for c in (0, 2, 3) for t in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert conversations.runs(conversations.faulted(conversations.damage(df))).where("conv_id = 1").count() > 1
    check(spark, rows)


def test_all_rows_dropped_and_no_rows(spark):
    gone = [(c, t, "user", "Hi.", None) for c in range(40) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    assert gone
    got = check(spark, gone)
    assert set(got.values()) == {(0, 0, 0, 0, 0, 0, "", conversations.NO_ROWS)}
    assert conversations.repair(spark.createDataFrame([], SCHEMA)).count() == 0
