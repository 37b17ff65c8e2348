import hashlib
import random
import re

from dyadlake.llm.pii import KINDS, base_spans, find_pii, luhn, patterns

from helpers import AWKWARD, DOCS, frame

GRAMMAR = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = []
    for k, g in enumerate(GRAMMAR):
        for m in re.finditer(g, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (True, k != 1 or all(int(p) <= 255 for p in m.group().split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_the_plain_grammar():
    rng = random.Random(5)
    parts = ["a.b@c.d", "x@y", "@@", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "001.02.3.4", "4387513035237269", "4387 5130-3523 7269", "+1 (988) 555-2485", "+12", "a@b.c_d@e.f", " ", "-", "é", "\n", "7", "+", "(", "..", "1 2"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))
        assert base_spans(text) == plain(text), text


def whole(row):
    """Counts, hash and spans of a row as the plain grammar gives them."""
    spans = [(s, k, e) for s, k, e in plain(row[1] or "")]
    line = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
    return [sum(k == n for _, k, _ in spans) for n in range(4)], hashlib.sha256(line.encode()).hexdigest(), set(filter(None, line.split(",")))


def test_awkward_rows(spark):
    rows = find_pii(frame(spark)).collect()
    assert sorted(r.doc_id for r in rows) == [d for d, *_ in AWKWARD]
    for r in rows:
        assert r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() and r.n_spans == r.n_added == 0
    assert find_pii(frame(spark, AWKWARD[:1]).limit(0)).collect() == []


def test_patterns_discover_unseen_identifiers(spark):
    rows = [(k, f"word tel: +1 (583) 555-{1000 + k} and é more", "en", "a", 0) for k in range(40)]
    rows += [(100, "my tel: (583) 555-8469 here", "en", "a", 0), (101, "total: 583-555-8469 units", "en", "a", 0), (101, "tel: 583-555-8469, mail a@b.org", "en", "a", 0)]
    got = sorted((r.doc_id, r.spans, r.n_added, r.n_spans) for r in find_pii(spark.createDataFrame(rows, DOCS)).collect() if r.doc_id >= 100)
    assert got == [(100, "phone:8:22", 1, 1), (101, "", 0, 0), (101, "phone:5:17,email:24:31", 1, 2)]
    assert KINDS == ("email", "ip", "card", "phone")


def test_discoveries_seed_further_patterns(spark):
    """Prose, other scripts, right contexts and two hops: the second context has no seed, only what the first one discovers."""
    rng = random.Random(1)
    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    rows, hop = [], [phone() for _ in range(8)]
    rows += [f"you may call me at +1 {phone()} any day" for _ in range(20)]
    rows += [f"please call me at {p} any time {k}" for k, p in enumerate(hop)]
    rows += [f"Téléphone du bureau {p} merci" for p in hop]
    rows += [f"電話番号 {phone()} です" for _ in range(3)] + [f"電話番号 +81 {phone()} です" for _ in range(9)]
    planted = [f"Téléphone du bureau {phone()} merci" for _ in range(4)]
    clean = [f"part number {phone()} in stock" for _ in range(20)] + [f"the year {k} was at {k}% of it" for k in range(1900, 1930)]
    rows += planted + clean
    got = {r.doc_id: r for r in find_pii(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    for k, text in enumerate(rows):
        counts, sha, base = whole((k, text))
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha and base <= set(filter(None, r.spans.split(",")))
        assert r.n_spans == len(list(filter(None, r.spans.split(",")))) == sum(counts) + r.n_added
    found = {rows[k] for k, r in got.items() if r.n_spans}
    assert set(planted) <= found and all(t in found for t in rows if "call me at" in t or "電話" in t)
    assert not found & set(clean)


def test_secrets_of_any_length_in_their_context(spark):
    rng = random.Random(2)
    key = lambda n: "a1" + "".join(rng.choice("abcdef0123456789") for _ in range(n - 4)) + "9f"
    rows = [f'words token = "{key(40)}" words' for _ in range(12)] + [f'token = "{key(20)}"', f'token = "{key(5000)}"', f'digest = "{key(20)}"', "token = word"]
    got = [r.spans for r in find_pii(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got[:12] == ["secret:15:55"] * 12 and got[12:] == ["secret:9:29", "secret:9:5009", "", ""]


def score_by_hand(cues, rounds, floor, least):
    """The graph's patterns by plain loops."""
    total, edges, seeds = {}, {}, set()
    for kind, token, seed, contexts in cues:
        for c in set(contexts):
            total[c] = total.get(c, 0) + 1
            if kind:
                edges[c, kind, token] = edges.get((c, kind, token), 0) + 1
        if seed:
            seeds.add((kind, token))
    conf, good = {x: 1.0 for x in seeds}, {}
    for _ in range(rounds):
        good = {}
        for c, kind in {(c, k) for c, k, _ in edges}:
            mine = {t: n for (x, k, t), n in edges.items() if (x, k) == (c, kind)}
            share = sum(n * conf.get((kind, t), 0) for t, n in mine.items()) / total[c]
            if share >= least and sum(conf.get((kind, t), 0) >= least for t in mine) >= floor:
                good[c, kind] = share
        new = {}
        for c, kind, token in edges:
            if (kind, token) not in seeds and (c, kind) in good:
                new[kind, token] = 1 - (1 - new.get((kind, token), 0)) * (1 - min(good[c, kind], 0.999))
        if len(conf) == len(seeds) + len(new) and conf.keys() >= new.keys():
            break
        conf = {**{x: 1.0 for x in seeds}, **new}
    return good


def test_scores_match_plain_loops(spark):
    rng = random.Random(7)
    for seed in range(3):
        cues = [(rng.choice(["phone", "phone", "card", None]), f"t{rng.randrange(25)}", False, rng.sample(["a", "b", "c", "d", "e", "f"], 2)) for _ in range(200)]
        cues = [(k, t, k == "phone" and int(t[1:]) % 2 == 0, c) for k, t, _, c in cues]
        frame_ = spark.createDataFrame(cues, "kind string, token string, seed boolean, contexts array<string>")
        got = {(r.context, r.kind): round(r.conf, 6) for r in patterns(frame_, 6, 3, 0.35).collect()}
        assert got == {k: round(v, 6) for k, v in score_by_hand(cues, 6, 3, 0.35).items()}
