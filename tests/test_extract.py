from strata.operators import extract
from strata.operators.extract import parse_records


def test_parse_records_cases(spark):
    rows = [
        ("u1", '("entity"<|>"Rope"<|>"tool"<|>"Rope is a tool.")##\n'
               '("relationship"<|>"Rope"<|>"Anchor"<|>"Rope ties to Anchor."<|>7)<|COMPLETE|>'),
        ("u2", "<|COMPLETE|>"),
        ("u3", '("entity"<|>"Knot"<|>"tool")<|COMPLETE|>'),
        ("u4", '("relationship"<|>"A"<|>"B"<|>"d"<|>high)'),
    ]
    df = spark.createDataFrame(rows, "unit_id string, response string")
    p = {(r.unit_id, r.kind): r for r in parse_records(df).collect()}
    assert p[("u1", "entity")].valid and p[("u1", "entity")].f1 == "ROPE"
    rel = p[("u1", "relationship")]
    assert rel.valid and rel.strength == 7.0 and "COMPLETE" not in rel.raw
    assert not any(k[0] == "u2" for k in p)            # completion marker only -> no record
    assert not p[("u3", "entity")].valid                # 3 fields -> quarantine
    assert not p[("u4", "relationship")].valid          # non-numeric strength -> quarantine


def _units(spark, rows):
    return spark.createDataFrame([(f"u{k}", k, "admin", t) for k, t in rows], "id string, doc_id long, level string, text string")


def _pairs_of(rows):
    """(first sentence by title, strength and description by pair) of (title, sent_ix, sentence) rows."""
    first, pairs = {}, {}
    for k, (t, i, s) in enumerate(rows):
        first.setdefault(t, s)
        if k + 1 < len(rows) and rows[k + 1][0] != t:
            n, j, x = rows[k + 1]
            key = (min(t, n), max(t, n))
            pairs[key] = (pairs[key][0] + 1, pairs[key][1]) if key in pairs else (1, s if i == j else f"{s} {x}")
    return first, pairs


def test_mentions_need_no_shuffle_and_equal_plain_loops(spark):
    import re

    from strata.operators import extract
    texts = ["Rope ties Anchor. Anchor holds Rope and Boat! no names here. Rope", "", "Ähre und Öl\nÄhre", "A Bb Bb Cc Bb Cc. Bb"]
    long = "Knot Rope. " * 1000          # past LONG_UNIT: put in order by windows
    rows = list(enumerate(texts + [long])) + [(3, texts[3])]          # one unit comes twice
    m = extract.mentions(_units(spark, rows), type_filter=False)
    ents, rels = extract.unit_entities(m).collect(), extract.unit_relationships(m).collect()
    for k, text in enumerate(texts + [long]):
        found = [(w.upper(), i, s.strip()) for i, s in enumerate(re.findall(r"[^.!?\n]+[.!?]?", text))
                 for w in re.findall(r"(?<![^\W\d_])[A-ZÄÖ][^\W\d_]+", s)]
        first, pairs = _pairs_of(found)
        assert {r.title: r.description for r in ents if r.doc_id == k} == first
        assert {(r.source, r.target): (r.strength, r.description) for r in rels if r.doc_id == k} == pairs
        assert len([r for r in ents if r.doc_id == k]) == len(first) and len([r for r in rels if r.doc_id == k]) == len(pairs)
    arrays = extract._from_arrays(extract._listed(_units(spark, rows), True))
    kept = extract.unit_relationships(arrays).unionByName(extract.unit_relationships(arrays))
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()


def test_sentences_are_listed_once(spark):
    # a filter on empty lists, made for the generator, had the whole listing computed twice
    units = spark.createDataFrame([("u1", 1, "admin", "Alpha met Beta. Gamma saw Alpha. nothing"), ("u2", 1, "admin", "no name")],
                                  "id string, doc_id long, level string, text string")
    m = extract.mentions(units)
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(text") == 2          # units by arrays, units by windows
    got = [(r.pos, r.title, r.n_title, r.first, r.strength) for r in m.orderBy("pos").collect()]
    assert got == [(0, "ALPHA", "BETA", True, 1), (1, "BETA", "GAMMA", True, 1), (2, "GAMMA", "ALPHA", True, 1),
                   (3, "ALPHA", None, False, 0)]
