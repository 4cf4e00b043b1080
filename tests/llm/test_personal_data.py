import hashlib
import re

from strata.llm import personal_data as pd_
from tests.llm.helpers import SF, docs_frame, documents, with_clashes


def plain(text):
    """Base spans read straight from the rules, without shortcuts."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        double = [2 * x - 9 * (x > 4) for x in d[-2::-2]]
        if 16 <= len(d) <= 19 and (sum(d[-1::-2]) + sum(double)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def row(i, text):
    spans = plain(text)
    line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (i, *(sum(k == n for k, _, _ in spans) for n in pd_.KINDS), hashlib.sha256(line.encode()).hexdigest()), line


ROWS = [
    (1, None), (2, ""), (3, "é a.b@c.de, x@y, 1.2.3.4 and 1.2.3.400 or 1.2.3.4.5"), (4, "4111 1111 1111 1111 and 4111111111111112"),
    (5, "+1 (988) 555-2485 +12 34 +1 23456789 4111111111111111"), (5, "+1 (988) 555-2485 +12 34 +1 23456789 4111111111111111"),
    (None, "mail me@x.org"), (6, "9" * 5000 + ".1.1.1"), (7, "000001.02.3.255"), (8, "words " * 30_000 + "z@z.zz"), (9, "𝔘 q@r.st 日本"),
    *[(20 + i, f"please call our desk +1 555 {1000000 + i} for more help") for i in range(8)],
    (40, "please call our desk 555-123-9876 for more help"), (41, "there were 555-123-9876 of them"), (42, "item code 123-4567-890 was sold"),
]


def query(spark, df):
    from unittest import mock

    with mock.patch.object(pd_, "load", lambda *_: df):
        return pd_.op8_personal_data(spark, "")


def test_odd_rows_and_discovery(spark):
    got = query(spark, with_clashes(docs_frame(spark, ROWS).repartition(4))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted((row(*r)[0] for r in ROWS), key=str)
    by = {r.doc_id: r for r in got}
    text = ROWS[-3][1]
    at = text.index("555")
    assert by[40].spans == f"phone:{at}:{at + 12}" and by[40].n_added == 1 and by[40].n_phone == 0
    assert by[42].spans == "" and by[3].spans == row(*ROWS[2])[1]
    assert by[41].n_added == 0  # its own words are not trusted


def test_table_and_empty(spark):
    want = {i: row(i, t) for i, t, _ in documents(spark)}
    for r in pd_.op8_personal_data(spark, SF).collect():
        base, line = want[r.doc_id]
        assert tuple(r)[:6] == base
        assert set(filter(None, line.split(","))) <= set(r.spans.split(",")) and (r.n_added or r.spans == line)
    assert query(spark, docs_frame(spark, [])).count() == 0


def test_spelled_addresses_without_at_sign(spark):
    for said in ("JOHN (AT) EXAMPLE.COM", "JOHN AT EXAMPLE DOT COM", "john at example.com", "John {At} example.com", "john [at] example [dot] com"):
        text = f"please write to {said} for details"
        found = [(text[a:b], seed) for k, a, b, _, seed, _ in pd_.mentions_of(text, []) if k == 0]
        assert found == [(said, False)]
    rows = [(i, f"please write to user{i}@mail.org for details") for i in range(20)]
    rows += [(40, "please write to JOHN AT EXAMPLE DOT COM for details"), (41, "please write to mary at example.com for details"),
             (42, "we met at home. Then it rained")]
    by = {r.doc_id: r for r in query(spark, docs_frame(spark, rows)).collect()}
    assert by[40].spans == "email:16:39" and by[41].spans == "email:16:35" and by[42].spans == ""


def brute_added(texts):
    """Spans added per row: patterns and instances scored by plain loops over all mentions."""
    mentions = [(i, m) for i, t in enumerate(texts) for m in pd_.mentions_of(t or "", pd_.base_spans(t or ""))]
    edges = {}  # (kind, pattern, instance) -> is a seed
    for _, (kind, _, _, instance, seed, patterns) in mentions:
        for p in patterns:
            edges[kind, p, instance] = edges.get((kind, p, instance), False) or seed
    seeds = {}
    for (kind, _, instance), seed in edges.items():
        seeds[kind, instance] = max(seeds.get((kind, instance), 0.0), float(seed))
    score, trust = dict(seeds), {}
    for _ in range(pd_.ROUNDS):
        for kind, p in {e[:2] for e in edges}:
            near = [score[kind, x] for k, q, x in edges if (k, q) == (kind, p)]
            trust[kind, p] = sum(near) / (len(near) + pd_.SMOOTHING) if sum(near) >= pd_.MIN_SEEDS else 0.0
        miss = {x: 1.0 for x in seeds}
        for kind, p, x in edges:
            miss[kind, x] *= max(1e-9, 1 - trust[kind, p])
        score = {x: max(seeds[x], 1 - miss[x]) for x in seeds}
    out = [set() for _ in texts]
    for i, (kind, a, b, instance, seed, patterns) in mentions:
        if not seed and any(trust[kind, p] >= pd_.CONFIDENCE for p in patterns) and score.get((kind, instance), 0.0) >= pd_.CONFIDENCE:
            out[i].add((kind, a, b))
    return [sorted(x) for x in out]


def test_added_spans_by_plain_loops(spark):
    texts = [r[1] for r in ROWS if r[0] != 8]
    texts += [f"send mail to user{i}@site{i % 3}.org or call +1 555 20{i:05d} today" for i in range(12)]
    texts += [f"send mail to user{i} at site.org or call 555-20{i:05d} today" for i in range(12)]
    texts += [f"card no: 4111 1111 1111 {1000 + i} ok" for i in range(40)] + ["card no: 1234 5678 9012 3456 ok", "host is 10.0.0.1 up", "host is 10 . 0 . 0 . 2 up"]
    texts += [f"host is 10.0.{i}.1 up" for i in range(9)]
    got = pd_.personal_data(docs_frame(spark, list(enumerate(texts))).repartition(3)).collect()
    want = brute_added(texts)
    assert {r.doc_id: [tuple(s) for s in r.added] for r in got} == dict(enumerate(want))
    assert sum(map(len, want)) > 10
