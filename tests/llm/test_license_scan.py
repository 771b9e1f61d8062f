import random
import re

from driftwood.llm import license_scan as L

from .helpers import DOCS, LOREM, by_id, docs_of, edge_docs, empty_docs


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def brute(rows, templates):
    """Exact containment in every window of the grid, without MinHash."""
    out = []
    for i, t in rows:
        w, names = words(t), []
        for name, text in sorted(templates.items()):
            tw = words(text)
            k = min(5, len(tw))
            own = {tuple(tw[j:j + k]) for j in range(len(tw) - k + 1)}
            size = 1
            while size < len(own):
                size *= 2
            step = max(1, size // 2)
            sh = [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
            if any(100 * len(own & set(sh[a:a + size + step - 1])) >= 80 * len(own) for a in range(0, len(sh), step)):
                names.append(name)
        out.append((i, len(names), ",".join(names)))
    return by_id(out)


def made():
    rng = random.Random(6)
    rows = list(DOCS)
    names = sorted(L.TEMPLATES)
    for k in range(4 * len(names)):  # each of the templates in each of the four ways
        name = names[k // 4]
        w = L.TEMPLATES[name].split()
        if k % 4 == 1:  # near: one word changed
            w[rng.randrange(len(w))] = "changed"
        if k % 4 == 2:  # less: cut short
            w = w[:rng.randrange(1, len(w) + 1)]
        fill = lambda: [rng.choice(LOREM) for _ in range(rng.randrange(0, 40))]
        rows.append((100 + k, " ".join(fill() + [x.upper() if k % 5 == 0 else x for x in w] + fill())))
    return rows


def test_equals_brute_force(spark):
    rows = made()
    got = by_id(map(tuple, L.query(docs_of(spark, rows).repartition(3)).collect()))
    want = brute(rows, L.TEMPLATES)
    assert got == want
    assert sum(r[1] for r in want) > 60


def test_bands_guarantee():
    s = L.least_similarity(80)
    assert 1 - (1 - s) ** L.bands_for(s) >= L.SURE > 1 - (1 - s) ** (L.bands_for(s) - 1)


def test_spans_and_edge_cases(spark):
    text = "one two three four five six Released under the MIT License. seven"
    got = L.scan_licenses(docs_of(spark, [(1, text)])).first().licenses
    assert [(m["name"], m["contained"], m["start"], m["end"]) for m in got] == [("mit", 1.0, 6, 11)]
    assert by_id((r.id,) for r in L.scan_licenses(edge_docs(spark)).collect()) == by_id((i,) for i, _ in DOCS)
    assert L.query(empty_docs(spark)).count() == 0
    assert {r.n_licenses for r in L.scan_licenses(edge_docs(spark), {}).selectExpr("size(licenses) AS n_licenses").collect()} == {0}


def test_no_python_in_the_plan(spark):
    plan = L.query(edge_docs(spark))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "MapInArrow"))
