"""Each pipeline stage against a plain version, on its predecessor's output."""

import random

import corpus_pipeline
from hearth.llm.common import cut
from tests.llm import test_decontam, test_linededup, test_minhash, test_mixing

BAD = "you are a zzgrot and such a zzgrot today"


def tables(spark, folder):
    """Clean, toxic, copied, near-copied and leaking documents; null, empty and repeated rows; clashing columns."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4)))
    line = lambda n: " ".join(word() for _ in range(n))
    items = [(i, line(30)) for i in range(6)]
    docs, labels = [], []
    for i in range(90):
        docs.append((i, "\n".join(line(rnd.randint(6, 25)) for _ in range(rnd.randint(2, 6)))))
        labels.append((i, 1, 0))
    for i in range(100, 130):
        docs.append((i, line(20) + "\n" + BAD + " " + line(12)))
        labels.append((i, 0, 1))
    base = [word() for _ in range(300)]
    for i in range(200, 206):  # near copies on one line, four edits apart
        w = list(base)
        for k in range(2):
            w[20 * k + i % 5] = f"edit{i}x{k}"
        docs.append((i, " ".join(w)))
    passage = line(60)
    docs += [(300 + i, line(15) + "\n" + passage + "\n" + line(15)) for i in range(5)]
    docs += [(400 + i, line(20) + "\n" + items[i][1] + "\n" + line(9)) for i in range(3)]
    docs += [(500, docs[3][1]), (501, docs[4][1]), (510, None), (511, ""), (512, " \n "), (513, line(5000))]
    rows = [(d, t, "en", ["a", "b", None, "a"][d % 4], len(t or ""), "x", 7) for d, t in docs]
    rows += [rows[0]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, row int").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items + [(90, None), (91, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return items


def test_every_stage(spark, scratch):
    items = tables(spark, scratch)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = cut(stage(spark, docs, scratch))
        seen[name] = before, docs.collect()
        assert docs.columns == (columns if name != "mix" else columns + ["copies", "taken"])
    before, after = seen["toxicity"]
    assert sorted(str(r.doc_id) for r in after) == sorted(str(d) for d, _, _ in before if not 100 <= d < 130)
    before, after = seen["line_dedup"]
    want = test_linededup.brute([(d, t) for d, t, _ in dict.fromkeys(before)])
    assert {r.doc_id: r.text for r in after} == {d: t for d, t in want.items() if d >= 510 and d < 513 or t.strip()}
    assert not {500, 501} & {r.doc_id for r in after}
    before, after = seen["near_dedup"]
    rows = test_minhash.brute([(d, t) for d, t, _ in before])
    keep = {c for d, n, c, k in rows if n} | {d for d, n, c, k in rows if not n}
    assert sorted(r.doc_id for r in after) == sorted(keep) and len([d for d in keep if 200 <= d < 206]) < 6
    before, after = seen["decontaminate"]
    bad = {x[0] for x in test_decontam.plain_leaks([(d, t) for d, t, _ in before if d in range(390, 410)], items)}
    assert bad == {400, 401, 402} and sorted(r.doc_id for r in after) == sorted(d for d, _, _ in before if d not in bad)
    before, after = seen["mix"]
    want = {d: t for d, _, _, _, t in test_mixing.plain_mix(before)}
    assert {r.doc_id: r.taken for r in after} == {d: t for d, t in want.items() if t}


def test_empty_tables(spark, scratch):
    tables(spark, scratch)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{scratch}/{name}.parquet").limit(0).write.parquet(f"{scratch}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{scratch}/none").count() == 0
