"""C2 against a brute-force, one-candidate-at-a-time simulation of the spec."""

import random

from rollcall.operators.usernames import allocate_usernames

STRIP = set("' -;@#$%!.,/")


def san(x):
    return "".join(ch for ch in x if ch not in STRIP).lower()


def simulate(cands, existing):
    taken = {(d, n.lower()) for d, n in existing}
    out = {}
    cs = sorted(cands, key=lambda c: c["k"])
    for c in cs:
        c["base"] = san(c["ov"].split("@")[0]) if c["ov"] is not None else (
            san(c["g"] + c["f"]) if c["g"] is not None and c["f"] is not None else None)
        mi = (c["m"] or "")[:1]
        c["alt"] = san(c["g"] + mi + c["f"]) if c["ov"] is None and mi and c["g"] is not None \
            and c["f"] is not None else None
    live = []
    for c in cs:
        if not c["base"]:
            out[c["k"]] = (None, "no name")
        else:
            live.append(c)
    claims = set()
    for c in [c for c in live if c["ov"] is not None]:
        key = (c["d"], c["base"])
        if key in taken:
            out[c["k"]] = (None, "override taken")
        elif key in claims:
            out[c["k"]] = (None, "override repeated")
        else:
            claims.add(key)
            out[c["k"]] = (c["base"], None)
    taken |= claims
    first, rest = {}, []
    for c in [c for c in live if c["ov"] is None]:
        key = (c["d"], c["base"])
        if key not in first:
            first[key] = c
        if first[key] is c and key not in taken:
            out[c["k"]] = (c["base"], None)
        else:
            rest.append(c)
    taken |= {(c["d"], c["base"]) for c in live if c["ov"] is None and out.get(c["k"], (None,))[0]}
    need, afirst = [], {}
    alt_claims = set()
    for c in rest:
        if c["alt"] is None:
            need.append((c, c["base"]))
            continue
        key = (c["d"], c["alt"])
        if key not in afirst:
            afirst[key] = c
        if afirst[key] is c and key not in taken:
            out[c["k"]] = (c["alt"], None)
            alt_claims.add(key)
        else:
            need.append((c, c["alt"]))
    taken |= alt_claims
    while need:
        got, counters = [], {}
        for c, stem in sorted(need, key=lambda x: x[0]["k"]):
            kth = counters.get((c["d"], stem), 0) + 1
            counters[(c["d"], stem)] = kth
            s, free = 0, 0
            while free < kth:
                s += 1
                if (c["d"], stem + str(s)) not in taken:
                    free += 1
            got.append((c, stem, stem + str(s)))
        winners, need = set(), []
        for c, stem, name in sorted(got, key=lambda x: x[0]["k"]):
            if (c["d"], name) in winners:
                need.append((c, stem))
            else:
                winners.add((c["d"], name))
                out[c["k"]] = (name, None)
        taken |= winners
    return out


def _case(seed, n=70):
    rnd = random.Random(seed)
    given = ["ann", "an", "bob", "Mary-Jo", None]
    family = ["1", "n1", "lee", "", "O'Neil", "n"]
    cands = []
    for k in range(n):
        ov = rnd.choice([None] * 8 + ["ann@x.org", "Bob.Lee@y.org"])
        cands.append(dict(k=k, d=rnd.choice(["a.org", "b.org"]), g=rnd.choice(given), f=rnd.choice(family),
                          m=rnd.choice([None, "", "Quinn", "Zed"]), ov=ov))
    existing = [(d, n) for d in ("a.org", "b.org") for n in ("ann", "ann1", "ann2", "ann11", "bob", "bob1", "annz")]
    return cands, existing


def _spark(spark, cands, existing):
    cdf = spark.createDataFrame([(c["k"], c["d"], c["g"], c["f"], c["m"], c["ov"]) for c in cands],
                                "k int, domain string, given_name string, family_name string, middle_name string,"
                                " override string")
    edf = spark.createDataFrame(existing, "domain string, name string")
    res = allocate_usernames(cdf, edf, ["k"]).select("k", "username", "reject_reason").collect()
    return {r.k: (r.username, r.reject_reason) for r in res}


def test_matches_sequential_spec(spark):
    for seed in (1, 2, 3):
        cands, existing = _case(seed)
        want = simulate([dict(c) for c in cands], existing)
        got = _spark(spark, cands, existing)
        assert got == want, seed


def test_unique_and_free_per_domain(spark):
    cands, existing = _case(9, 90)
    got = _spark(spark, cands, existing)
    dom = {c["k"]: c["d"] for c in cands}
    names = [(dom[k], u) for k, (u, _) in got.items() if u]
    assert len(names) == len(set(names))
    assert not set(names) & set(existing)
    assert len(got) == len(cands)  # nothing dropped


def test_stems_that_meet_name_everybody(spark):
    """Stems a, a1 and a11 run into each other again and again; nobody is rejected and no name is given twice."""
    cands = [dict(k=k, d="a.org", g="a", f=["", "1", "11"][k % 3], m=None, ov=None) for k in range(300)]
    got = _spark(spark, cands, [])
    names = [u for u, _ in got.values()]
    assert None not in names and len(set(names)) == len(cands)


def test_stable_under_input_order(spark):
    cands, existing = _case(5)
    a = _spark(spark, cands, existing)
    b = _spark(spark, list(reversed(cands)), existing)
    assert a == b


def test_hot_name_a_third_of_candidates(spark):
    cands = []
    for k in range(240):
        hot = k % 3 == 0
        cands.append(dict(k=k, d="a.org", g="Ann" if hot else f"u{k}", f="Lee" if hot else "x",
                          m="Q" if k % 9 == 0 else None, ov=None))
    existing = [("a.org", n) for n in ("annlee", "annlee1", "annlee5", "annqlee", "annlee12")]
    want = simulate([dict(c) for c in cands], existing)
    got = _spark(spark, cands, existing)
    assert got == want
    hot_names = sorted(int(u[len("annlee"):]) for k, (u, _) in got.items()
                       if u and u.startswith("annlee") and u != "annlee" and k % 3 == 0)
    assert hot_names[:4] == [2, 3, 4, 6] and len(set(hot_names)) == len(hot_names)
