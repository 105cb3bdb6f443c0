import random

import xxhash

import corpus_pipeline
from corpuslink.llm import queries


def test_stages_keep_clean_documents_and_drop_the_rest(spark, tmp_path):
    rng = random.Random(1)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))

    item = prose(30)
    clean = [(i, f"{prose(60)}\n{prose(50)}") for i in range(60)]
    copy = f"{prose(80)}\n{prose(40)}"
    rows = clean + [(100 + k, copy) for k in range(20)]
    rows += [(200 + k, f"{prose(70)}\n{item}\n{prose(40)}") for k in range(3)]
    rows += [(300, None), (301, "12345 67890")]
    boiler = "All rights are reserved by the owner of this page"
    rows += [(400 + k, f"{prose(50)}\n{boiler}") for k in range(15)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination",
                                                       "best_fit_packing"]
    ids, texts = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, texts, str(tmp_path))
        assert out.columns == list(corpus_pipeline.COLUMNS)
        out.write.parquet(f"{tmp_path}/{name}")
        texts = spark.read.parquet(f"{tmp_path}/{name}")
        ids[name] = {r.doc_id for r in texts.select("doc_id").collect()}
    everything = {i for i, _ in rows}
    assert ids["language_id"] == everything - {300, 301}
    assert ids["line_dedup"] == ids["language_id"]
    assert ids["near_dedup"] == ids["line_dedup"] - set(range(101, 120))
    assert ids["decontamination"] == ids["near_dedup"] - {200, 201, 202}
    kept = {r.doc_id: r for r in texts.collect()}
    assert all(kept[i].text == t and kept[i].n_chars == len(t) for i, t in clean)
    assert all(boiler not in kept[400 + k].text for k in range(15))
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(packed["doc_id"]) == ids["decontamination"]
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES) and corpus_pipeline.QUERIES.keys() == {"pipeline"}


def plain_fingerprint(text):
    words = (text or "").lower().split()
    runs = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(8)

    def words(n):
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n)]

    rows = [(1000 + k, " ".join(words(90))) for k in range(20)] + [(2000, None), (2001, ""), (2002, "one two"), (None, None)]
    for group in range(25):
        base = words(220)
        rows.append((20 * group, " ".join(base)))
        for k in range(1, 6):
            w = list(base)
            w[rng.randrange(220)] = words(1)[0]
            rows.append((20 * group + k, " ".join(w)))
    rows += [rows[0], rows[0], (1000, rows[1][1]), (None, rows[2][1]), (None, "no id, no copy"), (None, "no id, no copy"), (5000, rows[30][1])]
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, "").collect()]
    assert len(kept) == len(set(group))
    assert {group[rows.index(k)] for k in kept} == set(group)
    for g in set(group):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == g]
        best = min((i is None, i or 0) for i in ids)
        assert sum(group[rows.index(k)] == g and (k[0] is None, k[0] or 0) == best for k in kept) == 1


def test_short_recurring_lines_go_in_the_pipeline(spark):
    rng = random.Random(10)

    def prose():
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(12))

    rows = [(k, f"{prose()}\nLes.\n\nRead more\n{k}\nPage {k}\n{prose()}") for k in range(14)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    for k, text in rows:
        lines = text.split("\n")
        assert got[k] == [lines[0], "", str(k), f"Page {k}", lines[6]]


def test_long_footers_of_short_pages_go_in_the_pipeline_and_copies_stay(spark):
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))

    footer = "\n".join(prose(17) for _ in range(3))
    rows = [(k, f"{prose(34)}\n{footer}") for k in range(30)]  # 203 own characters, 303 of the footer
    copy = [prose(12) for _ in range(20)]
    rows += [(100 + k, "\n".join(copy)) for k in range(30)]
    edited = {200 + k: [prose(12) if at == k % 20 else line for at, line in enumerate(copy)] for k in range(30)}
    rows += [(i, "\n".join(lines)) for i, lines in edited.items()]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_boilerplate(spark, docs, "").collect()}
    assert all(got[k] == rows[k][1].split("\n")[0] for k in range(30))
    assert all(got[i] == t for i, t in rows[30:])
