"""Registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.variants import once
from tickspark.llm import audio, bpe_codec, embedding_join, language_id, licenses, merkle, minhash, packing, periodic_runs, secrets, substring_dedup, suffix_dedup, token_counts


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = language_id.fit_language_model(docs, ~held_out)
    return language_id.identify_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json")
    coded = bpe_codec.encode_documents(docs, path, bpe_codec.lexicon_of(docs, path))
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json")
    counts = token_counts.count_tokens(docs, path, token_counts.count_transducer(docs, path))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), words_each=2, percent=80)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.9)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_documents(spark, sf_dir))
    n = lambda kind: secrets.count_of(F.col("base"), kind).alias(f"n_{kind}")
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
        secrets.joined(secrets.merged(F.col("base"), F.col("added"))).alias("spans"),
    )


def op8_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = audio.store_audio(_documents(spark, sf_dir))
    media = stored.select(F.struct("doc_id", "n_bytes", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256")).alias("doc"), "media")
    return audio.feature_digest(audio.audio_features(media, id_col="doc", keep_windows=False)).select(
        "doc.doc_id", "doc.n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "doc.media_bytes", "doc.media_sha256", "feature",
    )


def _total(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeated_bytes(_documents(spark, sf_dir), 100)
    return left.select("doc_id", "n_bytes", _total("removed").alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeated_passages(_documents(spark, sf_dir), 35)
    return left.select("doc_id", "n_words", _total("removed").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def _crc(column: str):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """The documents as the contract has them: of every tenth hash the words from one on repeat with a period."""
    h = _crc("doc_id")
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    rows = once(docs.select("doc_id", "text"), ["doc_id", "text"], g=F.floor(h / 10), words=F.when(h % 10 == 0, words))
    n = F.size("words")
    rows = once(rows.withColumn("n", n), ["doc_id", "text", "words", "n"], a=F.when(n > 0, F.col("g") % n).cast("int"), share=(F.col("g") % 8 + 3).cast("int"))
    rows = once(rows, ["doc_id", "text", "words", "n", "a"], p=F.floor((F.col("n") - F.col("a")) / F.col("share")).cast("int") + 1)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    moved = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("words", place(i))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), moved).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(planted_runs(_documents(spark, sf_dir)), min_words=6, min_periods=4)
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])), "\n")
    rows = once(found, ["doc_id", "runs", "collapsed"], best=F.when(F.size("runs") > 0, best), lines=F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""))
    length = -F.col("best.n")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).alias("exponent_milli"), F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    one_more = F.when((_crc("doc_id") % 7 == 0) & F.col("n_chars").isNotNull(), merkle.leaf_of([c if c != "n_chars" else F.col(c).cast("decimal(20,0)") + 1 for c in merkle.COLUMNS]))
    leaves = docs.select("doc_id", "lang", merkle.leaf_of([*merkle.COLUMNS]).alias("leaf"), one_more.alias("tampered"))
    proved = merkle.proofs(leaves)
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("steps"))
    rows = once(proved, ["doc_id", "leaf", "subroot", "root"], proof_sha256=F.sha2(merkle.siblings(F.col("steps")), 256), folded_root=folded)
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_documents(spark, sf_dir))
    base = F.filter("places", lambda p: p["base"])
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    words = F.transform("base", lambda p: p["word"])
    rows = once(found, ["doc_id", "n_words", "places"], base=base)
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )


def queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_bpe_round_trip": op3_bpe_round_trip,
        "op7_token_counts": op7_token_counts,
        "op4_minhash_dedup": op4_minhash_dedup,
        "op5_embedding_dedup": op5_embedding_dedup,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op6_secret_scan": op6_secret_scan,
        "op8_audio_features": op8_audio_features,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_license_scan": op13_license_scan,
    }


#: Words and windows as the contracts define them.
_WORDS = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _classes(ids: str, links: str) -> str:
    """Smallest reachable id by links (a < b), as a recursive table."""
    return f"""pairs AS MATERIALIZED (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
  reach(id, other) AS (SELECT id, id FROM {ids} WHERE id IN (SELECT a FROM pairs) UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.other),
  comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


OP4_SQL = f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS ws FROM documents),
  s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS g FROM w, unnest(range(1, greatest(len(ws), 2))) AS t(i) WHERE len(ws) > 0),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
  link AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
  ids AS (SELECT doc_id AS id FROM documents), {_classes("ids", "link")}
  SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
  FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.id = d.doc_id"""

OP5_SQL = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0),
  link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
  ids AS (SELECT vec_id AS id FROM embeddings), {_classes("ids", "link")},
  k AS (SELECT a, count(*) AS n FROM pairs GROUP BY 1)
  SELECT d.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, d.vec_id) AS component_id, coalesce(component_id, d.vec_id) = d.vec_id AS kept
  FROM embeddings d LEFT JOIN k ON k.a = d.vec_id LEFT JOIN comp ON comp.id = d.vec_id"""

OP9_SQL = """WITH b AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  w AS MATERIALIZED (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS k FROM b, unnest(range(0, len(h) // 2 - 99)) AS t(i)),
  later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
  gap AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM later),
  run AS (SELECT doc_id, i, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM gap),
  span AS MATERIALIZED (SELECT doc_id, r, min(i) AS a, max(i) + 100 AS z FROM run GROUP BY 1, 2),
  cut AS (SELECT doc_id, r, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM span),
  kept AS (SELECT b.doc_id, string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) || substr(any_value(h), 2 * max(z) + 1) AS h, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM cut JOIN b ON b.doc_id = cut.doc_id GROUP BY 1)
  SELECT b.doc_id, len(b.h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, b.h))) AS kept_sha256 FROM b LEFT JOIN kept ON kept.doc_id = b.doc_id"""

OP10_SQL = f"""WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS ws FROM documents),
  k AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 34), ' ')) AS k FROM w, unnest(range(1, len(ws) - 33)) AS t(i)),
  twice AS (SELECT doc_id, i FROM k WHERE k IN (SELECT k FROM k GROUP BY 1 HAVING count(*) > 1)),
  gone AS (SELECT DISTINCT doc_id, i + j AS i FROM twice, unnest(range(0, 35)) AS t(j)),
  word AS (SELECT doc_id, i, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(i)),
  kept AS (SELECT word.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY word.i) FILTER (gone.i IS NULL) AS kept FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i GROUP BY 1)
  SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""


_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""


def _leaf_sql(n_chars: str) -> str:
    values = [n_chars if c == "n_chars" else c for c in merkle.COLUMNS]
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in values) + ")"


def _tree_sql(name: str, keys: str, leaves: str) -> str:
    parents = "list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], '')))"
    return f"{name} AS ({leaves} UNION ALL SELECT {keys}lv + 1, {parents} FROM {name} WHERE len(l) > 1)"


OP12_SQL = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf_sql("(n_chars + 1)")} END AS tampered FROM documents),
  o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, leaf) - 1 AS i FROM v),
  {_tree_sql("t", "g, ", "SELECT g, 0 AS lv, list(leaf ORDER BY i) AS l FROM o GROUP BY g")},
  r AS MATERIALIZED (SELECT g, l[1] AS subroot, row_number() OVER (ORDER BY g) - 1 AS i FROM t WHERE len(l) = 1),
  {_tree_sql("u", "", "SELECT 0 AS lv, list(subroot ORDER BY i) AS l FROM r")},
  low AS (SELECT o.g, o.i, t.lv, CASE WHEN (o.i >> t.lv) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(t.l[xor(o.i >> t.lv, 1) + 1], '') AS s FROM o JOIN t ON t.g = o.g WHERE len(t.l) > 1),
  high AS (SELECT r.g, u.lv, CASE WHEN (r.i >> u.lv) % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(u.l[xor(r.i >> u.lv, 1) + 1], '') AS s FROM r, u WHERE len(u.l) > 1),
  a AS (SELECT g, i, list(s ORDER BY lv) AS steps FROM low GROUP BY g, i), b AS (SELECT g, list(s ORDER BY lv) AS steps FROM high GROUP BY g),
  p AS (SELECT o.doc_id, o.leaf, o.tampered, r.subroot, (SELECT l[1] FROM u WHERE len(l) = 1) AS root, list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
    FROM o JOIN r ON r.g = o.g LEFT JOIN a ON a.g = o.g AND a.i = o.i LEFT JOIN b ON b.g = o.g),
  f AS (SELECT *, list_reduce(list_concat([coalesce(tampered, leaf)], steps), lambda h, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root FROM p)
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL expresses on whole tables; tests hold the others against brute force."""
    return {"op4_minhash_dedup": OP4_SQL, "op5_embedding_dedup": OP5_SQL, "op9_suffix_dedup": OP9_SQL, "op10_substring_dedup": OP10_SQL, "op12_merkle_manifest": OP12_SQL}
