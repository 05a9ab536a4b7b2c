import hashlib
import itertools
import random
import re
import zlib

import pytest

from fundlake.llm import queries, turns

COLUMNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, slice STRING, kind STRING, _conv INT"
SOLID = re.compile(r"[^\x20\x09-\x0D]")


def ordered(rows):
    """(turn, role, text) rows as the operator orders them."""
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda row: (row[0] is not None, row[0] or 0, row[1][:32] + "\0" + row[2][:64], hashlib.sha256(f"{len(row[1])}:{row[1]}{row[2]}".encode()).hexdigest()))


def faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        found.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plain(rows):
    """Faults, least of the cheapest edits by a table of whole strings, and the repaired rows."""
    rows = ordered(rows)
    found = faults(rows)
    nothing, after = (10**9, "", []), {"": "u", "s": "u", "u": "a", "a": "u"}
    table = {s: (0, "", []) if s in ("", "a") else nothing for s in after}

    def with_inserts(best):
        for _ in range(4):
            for s, t in after.items():
                cost, edits, out = best[t]
                best[s] = min(best[s], (cost + 5, "I" + edits, [({"u": "user", "a": "assistant"}[t], "")] + out))
        return best

    table = with_inserts(table)
    for (_, role, text), fault in reversed(list(zip(rows, found))):
        late, new = 5 * (fault == "truncated"), {}
        for s, t in after.items():
            ways = [(table[s][0] + 2, "D" + table[s][1], table[s][2])]
            if fault not in ("blank", "duplicate"):
                cost, edits, out = table[t]
                ways.append((cost + 1 + late, "R" + edits, [({"u": "user", "a": "assistant"}[t], text)] + out))
                if role[:1] == t or (role[:1] == "s" and s == ""):
                    cost, edits, out = table[role[:1]]
                    ways.append((cost + late, "K" + edits, [(role, text)] + out))
            new[s] = min(ways, key=lambda w: w[:2])
        table = with_inserts(new)
    cost, audit, out = table[""]
    known = [t for t, _, _ in rows if t is not None]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return {
        "gaps": max(known) - min(known) + 1 - len(set(known)) if known else 0,
        **{kind: found.count(kind) for kind in ("blank", "duplicate", "truncated")},
        "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)),
        "cost": cost, "audit": audit, "repaired_sha256": digest,
    }, out


def some_rows(rng, n):
    roles = ("system", "user", "assistant", "assistant", "user", "tool", "", None)
    texts = ("One.", "Two!", "three", "", " \n", "Four?  ", None, *(f"text {k}." for k in range(30)))
    return [(rng.choice((None, *range(n + 3))) if rng.random() < 0.2 else k, rng.choice(roles), rng.choice(texts)) for k in range(n)]


def test_edits_are_the_least_of_the_cheapest():
    rng = random.Random(1)
    for n in range(40):
        for _ in range(6):
            rows = some_rows(rng, n)
            want, _ = plain(rows)
            codes = bytes(8 if fault in ("blank", "duplicate") else 2 * {"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + (fault == "truncated")
                          for (_, role, _), fault in zip(ordered(rows), faults(ordered(rows))))
            assert turns.edits_of(codes) == (want["cost"], want["audit"])


@pytest.mark.parametrize("piece_rows", [3, 4096])
def test_repair_equals_the_plain_table(spark, piece_rows):
    rng = random.Random(2)
    talks = {k: some_rows(rng, rng.randrange(1, 25)) for k in range(40)} | {None: some_rows(rng, 6), 900: some_rows(rng, 400)}
    talks[901] = [(k, ("user", "assistant")[k % 2], f"Row {k}." if k % 7 else "the same row") for k in range(500)]
    talks[902] = [(3, "user", "again and again.")] * 60 + [(None, "assistant", "x" * 100_000)]
    rows = spark.createDataFrame([(c, t, r, x, "s", "k", 5) for c, talk in talks.items() for t, r, x in talk], COLUMNS)
    got = {row.conv_id: row.asDict() for row in turns.repair(rows, rows.limit(0), piece_rows).collect()}
    assert set(got) == set(talks)
    for conv, talk in talks.items():
        assert got[conv] == {"conv_id": conv, **plain(talk)[0]}, conv
    written = {}
    for row in sorted(turns.repaired(rows, piece_rows).collect(), key=lambda r: r.position):
        written.setdefault(row.conv_id, []).append((row.role, row.text))
    assert written == {c: out for c, talk in talks.items() if (out := plain(talk)[1])}


def test_nothing_to_repair(spark):
    rows = spark.createDataFrame([], COLUMNS)
    assert turns.repair(rows).count() == 0 and turns.repaired(rows).count() == 0


def test_query_reports_every_conversation(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c, t, ("user", "assistant")[t % 2], f"Text {rng.random()}.") for c in range(300) for t in range(rng.randrange(1, 5))] + [(None, None, None, None), (7, None, "user", None)]
    spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").write.parquet(str(tmp_path / "conversations.parquet"))
    talks = {c: [] for c, *_ in rows}
    for c, t, r, x in rows:
        role, text = r or " ", x or " "
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (t, "user" if hit == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(hit, text))
        talks[c] += [row] * {0: 0, 3: 2}.get(hit, 1)
    got = {row.conv_id: row.asDict() for row in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: {"conv_id": c, **plain(talk)[0]} for c, talk in talks.items()}
    assert any(not talk for talk in talks.values())
