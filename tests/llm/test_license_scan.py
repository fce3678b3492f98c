import random

from churnlens.llm import license_scan as ls
from tests.llm.conftest import prose


def test_finds_templates_with_few_differences(spark):
    rng = random.Random(2)
    rows, want = [], set()
    for i, (name, text) in enumerate(ls.TEMPLATES.items()):
        body = prose(rng, 3000 if i == 0 else 40)
        rows += [(i, f"{body}\n{text}\n{body}"), (100 + i, f"{body} {text.upper().replace(' ', '  ')} {body}"),
                 (200 + i, text.replace(" ", "\n# "))]
        want |= {(i, name), (100 + i, name), (200 + i, name)}
        words = text.split()
        if len(words) >= 12:
            words[len(words) // 2] = "changed"
            rows.append((300 + i, " ".join(words)))
            want.add((300 + i, name))
    rows += [(900, None), (901, ""), (902, "a license to drive and a licence"), (903, prose(rng, 500)), (904, "Licensed under nothing"),
             (905, "Released under the MIT License. All rights reserved. Released under the MIT License.")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int").repartition(3)
    got = ls.scan_licenses(table).collect()
    by = {(r.doc_id, r.license) for r in got}
    assert by == want | {(905, "MIT"), (905, "all-rights-reserved")}
    texts = dict(rows)
    for r in got:
        if r.differences == 0:
            assert ls._words(texts[r.doc_id][r.start:r.end]) == ls._words(ls.TEMPLATES[r.license])
    assert sum(r.doc_id == 905 for r in got) == 3
    assert ls.scan_licenses(table.where("false")).count() == 0


def test_every_template_has_a_keyword():
    assert all(ls._KEY.search(t) for t in ls.TEMPLATES.values())


def brute(template, block):
    """Least word edit distance of the template to any run of the block."""
    prev = [0] * (len(block) + 1)
    for i, w in enumerate(template, 1):
        row = [i]
        for j, b in enumerate(block, 1):
            row.append(min(prev[j - 1] + (w != b), prev[j] + 1, row[-1] + 1))
        prev = row
    return min(prev)


def test_alignment_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        t = [rng.choice("abcd") for _ in range(rng.randint(2, 8))]
        b = [rng.choice("abcde") for _ in range(rng.randint(1, 20))]
        best = brute(t, b)
        got = ls.align(t, b)
        assert (got[0][0] if got else len(t)) == best
        for d, x, y in got:
            assert brute(t, b[x:y]) <= d


def test_longer_template_wins():
    got = ls.Scanner(ls.TEMPLATES, 0.1).scan("x " + ls.TEMPLATES["Apache-2.0-header"] + " y")
    assert [r["license"] for r in got] == ["Apache-2.0-header"]
    assert got[0]["rank"] == 1 and got[0]["reduction"] > 0.3


def test_any_allowed_change_is_found(spark):
    """Every template with as many changed, split or inserted words as slack
    allows, those of one kind first; the alignment alone is the judge."""
    rng = random.Random(6)
    rows = []
    for name, text in ls.TEMPLATES.items():
        words = text.split()
        n = int(0.1 * len(ls._words(text)))
        for case in range(40 if n else 1):
            w = list(words)
            hard = [k for k, x in enumerate(w) if ls.re.search("(?i)licen[sc]e|granted|redistribut|" + ls.KEYWORDS, x)]
            for k in sorted(rng.sample(hard if case % 2 and len(hard) >= n else range(len(w)), n), reverse=True):
                if len(ls._words(w[k])) == 1:
                    w[k:k + 1] = [["given"], [w[k], "inserted"]][case // 2 % 2]
            rows.append((f"{name} {case}", f"{prose(rng, 50)}\n{' '.join(w)}\n{prose(rng, 50)}"))
    rows += [("bsd", ls.TEMPLATES["BSD-notice"].replace("Redistribution", "Redistri-\nbution")),
             ("mit", ls.TEMPLATES["MIT-notice"].replace("granted", "given"))]
    got = {(r.doc_id, r.license) for r in ls.scan_licenses(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    want = {(i, name) for i, text in rows for name, t in ls.TEMPLATES.items()
            if brute(ls._words(t), ls._words(text)) <= 0.1 * len(ls._words(t))}
    assert got <= want and {i for i, _ in got} == {i for i, _ in want} == {i for i, _ in rows}
    assert {("bsd", "BSD-notice"), ("mit", "MIT-notice")} <= got


def test_given_templates(spark):
    own = {"Unlicense": "This is free and unencumbered software released into the public domain.",
           "short": "KİLO örnek", "none": "..."}
    table = spark.createDataFrame([(1, "x " + own["Unlicense"].upper() + " y"), (2, "bir kilo; bir \u212aİLO ÖRNEK"),
                                   (3, "All rights reserved.")], "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in ls.scan_licenses(table, own).collect()}
    assert got == {(1, "Unlicense"), (2, "short")}
    assert ls.scan_licenses(table, {}).count() == 0


def test_rank_decides_no_match():
    rng = random.Random(8)
    long = " conditions ".join(prose(rng, 40) for _ in range(40))
    for name, text in ls.TEMPLATES.items():
        got = ls.Scanner(ls.TEMPLATES, 0.1).scan(f"{long} {text} {long} {ls.TEMPLATES['BSD-notice']}")
        assert {r["license"] for r in got} == {name, "BSD-notice"}
        assert name == "BSD-notice" or any(r["rank"] > 1 for r in got)


def whole_text(text, slack=0.1):
    """Every template aligned to all words of the text: no anchors, blocks, windows or compression."""
    at = [(m.start(), m.end()) for m in ls._WORD.finditer(text)]
    ws = [text[x:y].lower() for x, y in at]
    hits, taken, out = [], [], []
    for i, (name, t) in enumerate(ls.TEMPLATES.items()):
        t = ls._words(t)
        hits += [(d - len(t), d, x, y, i, name) for d, x, y in ls.align(t, ws) if d <= slack * len(t)]
    for _, d, x, y, _, name in sorted(hits):
        if all(y <= p or x >= q for p, q in taken):
            taken.append((x, y))
            out.append((at[x][0], at[y - 1][1], name, d))
    return sorted(out)


def test_scan_against_the_whole_text():
    """No anchor, window or cut-off loses a match: edited notices, alone, several
    in a block, split over lines, amid text that shares their words."""
    rng = random.Random(12)
    scanner, seen = ls.Scanner(ls.TEMPLATES, 0.1), 0
    names = list(ls.TEMPLATES)
    for case in range(240):
        parts = [prose(rng, rng.randint(0, 120))]
        for name in rng.choices(names, k=rng.randint(0, 3)):
            w = ls.TEMPLATES[name].split()
            for _ in range(rng.randint(0, len(ls._words(ls.TEMPLATES[name])) // 10)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([["other"], [], [w[k], "more"]])
            parts += [rng.choice([" ", "\n# ", "  * "]).join(w), prose(rng, rng.choice([0, 3, 60]))]
        parts += rng.choices(["license", "Permission", "the License.", "free software", "Redistribution"], k=rng.randint(0, 4))
        text = "\n".join(parts)
        want = whole_text(text)
        got = sorted((r["start"], r["end"], r["license"], r["differences"]) for r in scanner.scan(text))
        assert {x[2] for x in got} == {x[2] for x in want} and len(got) == len(want), case
        assert [x[3] for x in got] == [x[3] for x in want], case
        seen += len(want)
    assert seen > 200 and scanner.aligned < scanner.read  # the reductions choose what is aligned


def test_null_ids_and_repeated_rows(spark):
    text = "x y z " + ls.TEMPLATES["MIT-notice"] + " a b c"
    table = spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], "doc_id long, text string")
    got = ls.scan_licenses(table).collect()
    assert sorted(str(r.doc_id) for r in got if r.license == "MIT-notice") == ["1", "1", "None"]
    assert len({(r.license, r.start, r.end, r.differences) for r in got}) * 3 == len(got)
