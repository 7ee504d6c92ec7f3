import random
import re

import corpus_pipeline as pipeline
import pytest
from samples import edits, text, words

from skyline.llm import toxicity
from skyline.llm.catalog import production_mix, table
from skyline.llm.decontamination import COVERAGE, LEAST_TILE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=repr)


def _full(rows):
    return sorted(((i, t, "en", "src0", None if t is None else len(t)) for i, t in rows), key=repr)


@pytest.fixture
def folder(spark, tmp_path, docs):
    """A folder of documents, labels and benchmark items."""

    def made(rows, items=(), labels=()):
        docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(list(items), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return made


def test_toxicity_stage(spark, docs, folder):
    """What stays are the rows that the scores leave, null and repeated ids included."""
    rng = random.Random(1)
    mild, harsh = [text(rng, 30) for _ in range(60)], [f"{text(rng, 20)} vile scum {text(rng, 5)} filth" for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(mild + harsh)] + [(None, harsh[0]), (None, mild[0]), (0, harsh[1]), (3, None)]
    root = folder(rows, labels=[(i, 1, int(i >= 60)) for i in range(120)])
    kept = _rows(pipeline.drop_toxic(spark, table(spark, root, "documents"), root))
    model = toxicity.learn(table(spark, root, "documents"), table(spark, root, "labels"))
    scores = toxicity.scored(table(spark, root, "documents"), model).collect()
    assert kept == sorted((tuple(r[c] for c in COLUMNS) for r in scores if r["score"] < toxicity.THRESHOLD), key=repr)
    assert (None, mild[0], "en", "src0", len(mild[0])) in kept and all("vile scum" not in (r[1] or "") for r in kept)
    assert (3, None, "en", "src0", None) in kept


def _near(a, b):
    own, other = ([w.lower() for w in words(x)] for x in (a, b))
    if not own or not other:
        return a == b  # texts without a word are alike only if they are equal
    return own == other or edits(own, other) <= int(0.2 * max(len(own), len(other)) + 1e-9)


def test_near_duplicate_stage(spark, docs):
    """One row of each class stays; no clean text is lost to a shared or missing id."""
    rng = random.Random(2)
    base = [text(rng, 60) for _ in range(8)]
    near = [re.sub(r"\S+$", "changed", t) for t in base[:4]]
    rows = [(10 + i, t) for i, t in enumerate(base)] + [(5 + i, t) for i, t in enumerate(near)] + [
        (10, base[5] + " and then some other words that are new here but near"), (10, text(rng, 40)), (None, text(rng, 40)), (None, base[1]), (None, base[2] + " x"),
        (11, base[1]), (11, base[1]), (99, None), (98, ""), (None, None), (97, " "),
    ]
    rng.shuffle(rows)
    kept = _rows(pipeline.drop_near_duplicates(spark, docs(rows), ""))
    classes = []
    for row in rows:
        touching = [c for c in classes if any(_near(row[1] or "", other[1] or "") for other in c)]
        classes = [c for c in classes if c not in touching] + [[row, *(r for c in touching for r in c)]]
    assert len(kept) == len(classes)
    for c in classes:
        least = min((i for i, _ in c if i is not None), default=None)
        found = [k for k in kept if (k[0], k[1]) in {(i, t) for i, t in c}]
        assert len(found) == 1 and found[0][0] == least


def test_rows_alone_in_their_class_are_not_joined(spark, docs, monkeypatch):
    """Only rows that may go, or have copies, are named for the joins with the classes."""
    named, build = [], pipeline.order_minhash.bitfilter.build
    monkeypatch.setattr(pipeline.order_minhash.bitfilter, "build", lambda values: (named.append(values.count()), build(values))[1])
    rng = random.Random(21)
    base = [text(rng, 50) for _ in range(9)]
    rows = [*enumerate(base), (20, base[0] + " more"), (30, base[1]), (31, base[2]), (2, base[2])]
    kept = _rows(pipeline.drop_near_duplicates(spark, docs(rows), ""))
    assert sorted((k[0], k[1]) for k in kept) == [*enumerate(base)]
    assert named[-1] == 3


def test_decontamination_stage(spark, docs, folder):
    rng = random.Random(3)
    items = [(i, text(rng, 40)) for i in range(6)] + [(7, None), (8, "")]
    clean = [text(rng, 80) for _ in range(6)]
    moved = lambda t: " ".join(t.split()[20:] + ["between", "them"] + t.split()[:20])
    rows = [(i, t) for i, t in enumerate(clean)] + [(2, f"{clean[0]} {items[1][1]} {clean[1]}"), (None, moved(items[2][1])), (None, clean[4]), (50, items[3][1].upper()),
            (51, " ".join(items[4][1].split()[:12]) + " " + clean[5]), (52, None), (2, clean[2] + " again")]
    root = folder(rows, items)
    kept = _rows(pipeline.drop_contaminated(spark, table(spark, root, "documents"), root))

    def shared(item, body):
        """Words of the item in common runs, greedily, longest first."""
        a, b = (re.findall(r"[^\W_]+", x.lower()) for x in (item, body))
        covered = 0
        while True:
            best = (0, 0, 0)
            for i in range(len(a)):
                for j in range(len(b)):
                    k = 0
                    while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and a[i + k] is not None:
                        k += 1
                    best = max(best, (k, -i, -j))
            k, i, j = best[0], -best[1], -best[2]
            if k < LEAST_TILE:
                return covered
            covered += k
            a[i:i + k], b[j:j + k] = [None] * k, [0] * k

    leaks = lambda t: any(x and shared(x, t or "") >= COVERAGE * len(re.findall(r"[^\W_]+", x)) for _, x in items)
    assert kept == _full([r for r in rows if not leaks(r[1])])
    assert len(kept) == len(rows) - 3


def test_secret_stage_keeps_all_rows(spark, docs):
    rows = [(1, "token = abcdef123456 rest"), (None, "password: hunter2hunter2"), (2, None), (2, "nothing here"), (3, "AKIA" + "A" * 20)]
    kept = _rows(pipeline.redact_secrets(spark, docs(rows), ""))
    assert [r[0] for r in kept] == [r[0] for r in _full(rows)] and len(kept) == len(rows)
    told = " ".join(r[1] or "" for r in kept)
    assert "abcdef123456" not in told and "hunter2hunter2" not in told and "AKIAAAA" not in told and "nothing here" in told


def test_whole_run(spark, docs, folder):
    """The run is its stages one after another, and ends with the mix of what they keep."""
    rng = random.Random(4)
    base = [text(rng, 60) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100, base[0]), (101, base[1] + " x"), (None, base[2]), (102, f"{base[3]} secret = abcdef123456")]
    root = folder(rows, [(1, text(rng, 30))], [(i, 1, 0) for i in range(20)])
    docs_, names = table(spark, root, "documents"), [name for name, _ in pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "mixing"]
    for name, stage in pipeline.STAGES[:-1]:
        before, docs_ = docs_, stage(spark, docs_, root)
        assert docs_.columns == before.columns
    own = sorted(map(repr, pipeline.STAGES[-1][1](spark, docs_, root).collect()))
    got = pipeline.run(spark, root)
    assert sorted(map(repr, got.collect())) == own and {"copies", "domain"} <= set(got.columns)
    assert production_mix().percent >= 1


def test_empty_tables(spark, folder):
    root = folder([])
    assert pipeline.run(spark, root).count() == 0
