"""The stages one by one against their own rules, and the whole run."""

import random

import corpus_pipeline
import public_tokenizers
from corpus_pipeline import COLUMNS, STAGES, run
from fundlake.llm.decontaminate import plain
from tests_support import write_tables
from tokenizers import Tokenizer


def prose(pick, words):
    return " ".join("".join(pick.choices(["ti", "on", "er", "ha", "st", "en", "lo"], k=pick.randrange(1, 5))) for _ in range(words))


def tables():
    pick = random.Random(2)
    good = [prose(pick, pick.randrange(60, 160)) for _ in range(60)]
    shared, leak = prose(pick, 70), prose(pick, 40)
    docs = [(n, good[n]) for n in range(60)]
    docs += [(100 + n, " | ".join(prose(pick, 80).upper().split())) for n in range(60)]
    docs += [(200, good[3] + " end"), (201, good[3]), (202, prose(pick, 40) + "\n" + shared), (203, prose(pick, 40) + " " + shared + " " + prose(pick, 9))]
    docs += [(204, prose(pick, 30) + " " + leak.upper() + ". " + prose(pick, 30)), (None, good[7] + " null id"), (205, good[5]), (205, good[6])]
    labels = [(n, 1, 0) for n in range(60)] + [(100 + n, 0, 0) for n in range(60)]
    return docs, labels, [(1, leak), (2, prose(pick, 30))], shared


def test_run_and_stages(spark, tmp_path):
    docs, labels, bench, shared = tables()
    folder = write_tables(
        spark, tmp_path,
        documents=([(d, t, "en", "s", len(t), "extra") for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long, n_removed string"),
        labels=(labels, "doc_id long, quality int, toxic int"), benchmark=(bench, "item_id long, text string"),
    )
    kept, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, step in STAGES:
        out = step(spark, kept, folder)
        out.write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        if name != STAGES[-1][0]:
            assert kept.columns == list(COLUMNS)
            assert all(r.n_chars == len(r.text) for r in kept.collect())
        seen[name] = kept.collect()
    texts = {name: {r.doc_id: r.text for r in rows} for name, rows in seen.items() if name != "pack"}
    assert not {100 + n for n in range(60)} & set(texts["quality"]) and set(range(60)) <= set(texts["quality"])
    gone = set(texts["quality"]) - set(texts["near_duplicate"])
    assert gone == {200, 201, 205}
    assert shared in texts["substring"][202].replace("\n", " ") and shared not in texts["substring"][203]
    assert texts["substring"][202] == dict(docs)[202] and texts["substring"][0] == docs[0][1]
    assert set(texts["substring"]) - set(texts["decontaminate"]) == {204}
    assert all(plain(bench[0][1]) not in plain(t) for t in texts["decontaminate"].values())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["decontaminate"])
    assert sum(r.length for r in seen["pack"]) == want
    assert {r.doc_id for r in seen["pack"]} == set(texts["decontaminate"])
    assert sorted(map(tuple, run(spark, folder).collect()), key=str) == sorted(map(tuple, seen["pack"]), key=str)


def test_null_texts_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in {"none": [], "odd": [(1, None, None, None, None), (2, "", "en", "s", 0), (None, None, None, None, None), (2, "", "en", "s", 0)]}.items():
        folder = write_tables(
            spark, tmp_path / name, documents=(rows, schema), labels=([], "doc_id long, quality int"), benchmark=([], "item_id long, text string")
        )
        assert len(run(spark, folder).collect()) == len(rows)
    assert corpus_pipeline.ORACLE_SQL is None
