"""The operators as named queries over the whole tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import (
    chosenpath,
    decontamination,
    editprints,
    language,
    linededup,
    merkle,
    mixing,
    ngrams,
    records,
    simhash,
    tokencounts,
    toxicity,
    trie,
)
from feedloom.session import scratch_folder, staged

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}

#: Where the public tokenizer files lie; a parameter of every function that needs one.
TOKENIZER = "byte_bpe_50k.json"
MAX_LABELLED = 20_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        LLM_QUERIES[run.__name__] = run
        if sql is not None:
            LLM_ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted on a bounded sample of the labelled rows that are not held out."""
    learn = toxicity.labelled_sample(docs, labels.where(~held_out()), MAX_LABELLED)
    return toxicity.Model(staged(toxicity.fit(learn), "toxicity-weights"))


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), model.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query(
    r"""
    WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    lines AS (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS pos FROM docs),
    keyed AS (
      SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM lines),
    owners AS (SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key),
    marked AS (SELECT k.*, coalesce(o.owner < k.doc_id, false) AS dropped FROM keyed k LEFT JOIN owners o USING (key))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


_BACKOFF_SQL = rf"""
    WITH docs AS (
      SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    tokens AS (
      SELECT doc_id, unnest(words) AS w, unnest(list_prepend(NULL, words[1:len(words) - 1])) AS p,
             unnest(list_prepend(NULL, list_prepend(NULL, words)[1:len(words) - 1])) AS q
      FROM docs WHERE len(words) > 0),
    ones AS (SELECT w, count(*) AS c FROM tokens GROUP BY w),
    twos AS (SELECT p, w, count(*) AS c FROM tokens WHERE p IS NOT NULL GROUP BY p, w),
    threes AS (SELECT q, p, w, count(*) AS c FROM tokens WHERE q IS NOT NULL GROUP BY q, p, w),
    scored AS (
      SELECT t.doc_id,
             CASE WHEN c3.c IS NOT NULL THEN ln(c3.c / before.c)
                  WHEN c2.c IS NOT NULL THEN ln(c2.c / alone.c) + CASE WHEN t.q IS NOT NULL THEN ln({ngrams.BACKOFF}::DOUBLE) ELSE 0 END
                  ELSE ln(c1.c / (SELECT sum(c) FROM ones)::DOUBLE)
                       + ((t.p IS NOT NULL)::INT + (t.q IS NOT NULL)::INT) * ln({ngrams.BACKOFF}::DOUBLE) END AS log
      FROM tokens t JOIN ones c1 ON t.w = c1.w LEFT JOIN ones alone ON t.p = alone.w
      LEFT JOIN twos c2 ON t.p = c2.p AND t.w = c2.w LEFT JOIN twos before ON t.q = before.p AND t.p = before.w
      LEFT JOIN threes c3 ON t.q = c3.q AND t.p = c3.p AND t.w = c3.w)
    SELECT d.doc_id, coalesce(len(d.words), 0)::BIGINT AS n_words, round(avg(s.log), 6) AS log_score
    FROM docs d LEFT JOIN scored s ON d.doc_id = s.doc_id GROUP BY d.doc_id, d.words
    """


@query(_BACKOFF_SQL)
def op3_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every n-gram up to order 3 counts; a word backs off only where the count is 0."""
    scored = ngrams.scores(table(spark, sf_dir, "documents"))
    return scored.select(F.col("id").alias("doc_id"), "n_words", F.round("log_score", 6).alias("log_score"))


@query(_BACKOFF_SQL)
def op3_trigram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores under the name they had before."""
    return op3_backoff_scores(spark, sf_dir)


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        tokencounts.token_count("text", tokenizer_path()).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_shingles(source: str, key: str) -> str:
    return rf"""
      SELECT DISTINCT {key}, array_to_string(words[i:least(i + 4, len(words))], ' ') AS shingle
      FROM (SELECT {key}, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i
            FROM (SELECT {key}, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
                  FROM {source}) WHERE len(words) > 0)"""


@query(
    f"""
    WITH item AS ({_sql_shingles("benchmark", "item_id")}),
         doc AS ({_sql_shingles("documents", "doc_id")}),
         sizes AS (SELECT item_id, count(*) AS n_shingles FROM item GROUP BY item_id),
         met AS (SELECT doc_id, item_id, count(*) AS n_found FROM item JOIN doc USING (shingle) GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, n_shingles::INT AS n_shingles, n_found::INT AS n_found, n_found / n_shingles AS containment
    FROM met JOIN sizes USING (item_id) WHERE n_found / n_shingles >= 0.8
    """
)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_shingles", "n_found", "containment")


@query(
    r"""
    WITH sized AS (
      SELECT doc_id, source, text,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
    per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (
      SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS weight,
             3 * source_size AS cap FROM per_source),
    filled AS (
      SELECT *, row_number() OVER o AS n,
             (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
               / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS share
      FROM weighed WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
    turn AS (SELECT min(n) AS n FROM filled WHERE cap / weight > share),
    targets AS (
      SELECT source, source_size,
             CASE WHEN f.n >= (SELECT n FROM turn) THEN (SELECT share FROM filled WHERE n = (SELECT n FROM turn)) * weight
                  ELSE cap::DOUBLE END AS target FROM filled f),
    placed AS (
      SELECT s.doc_id, s.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('mix:' || coalesce(s.source, '<null>')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY s.source
               ORDER BY length(bin(size)) * 8 + floor(size * 8 / pow(2.0, length(bin(size)))),
                        coalesce(abs(s.doc_id % 64), 0), size, s.doc_id NULLS LAST) AS place
      FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           ((floor(place * rate + u) - floor((place - 1) * rate + u)) * size)::BIGINT AS taken
    FROM placed
    """
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized = docs.select("doc_id", "source", F.xxhash64("text").alias("text"), mixing.word_count("text").alias("n_words"))
    taken = mixing.mix(sized, size_col="n_words")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document (its source as host) and every page (its markup and address)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.TextModel(staged(language.fit(docs), "language-counts"))
    host, suffix = language.address_parts("url")
    none = F.lit(None)
    rows = docs.select(
        "doc_id", none.cast("long").alias("page_id"), model.evidence("text").alias("text_log"),
        none.cast("string").alias("declared"), none.cast("string").alias("suffix"), F.col("source").alias("host"),
    ).union(
        pages.select(
            none.cast("long").alias("doc_id"), F.col("page_id").cast("long"),
            model.evidence(language.visible_text("html")).alias("text_log"),
            language.markup_language("html").alias("declared"), suffix.alias("suffix"), host.alias("host"),
        )
    )
    found = language.identify(staged(rows, "language-evidence"), model.languages)
    return found.select("doc_id", "page_id", "lang", F.round("probability", 6).alias("probability"))


@query()
def op8_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-records")
    records.write_records(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return records.digest(records.read_records(spark, folder))


@query()
def op9_edit_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = staged(editprints.compare_with_edits(table(spark, sf_dir, "documents")), "edit-compared")
    groups = editprints.similar_groups(found)
    return found.join(groups, "fingerprint").select(F.col("id").alias("doc_id"), *found.columns[1:], "group")


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def _sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: SQL has no such function."""
    bit = f"(CASE WHEN i % 8 = 0 THEN xor(acc, ascii({text}[i // 8 + 1])) ELSE acc END)"
    step = f"xor({bit} >> 1, 3988292384 * ({bit} & 1))"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, range(8 * length({text}))), "
        f"lambda acc, i: {step}), 4294967295::BIGINT)"
    )


_WORDS_SQL = r"len(regexp_extract_all({}, '[^\x20\x09-\x0D]+'))"


@query(
    f"""
    WITH own AS (
      SELECT conv_id AS c, conv_id::VARCHAR AS name,
             list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    drawn AS (SELECT c, turns, {_sql_crc32("name")} % 4 AS h FROM own),
    built AS (
      SELECT d.c, list_concat(coalesce(b.turns[1:d.h], []), d.turns[d.h + 1:]) AS path
      FROM drawn d LEFT JOIN own b ON b.c = d.c - d.c % 20),
    members AS (SELECT c, path, unnest(range(len(path) + 1)) AS depth FROM built),
    nodes AS (
      SELECT path[1:depth] AS node, depth, min(c) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(path) = depth), '')) AS ends_sha256
      FROM members GROUP BY ALL),
    parted AS (SELECT *, CASE WHEN depth > 0 THEN node[1:depth - 1] END AS above FROM nodes),
    kids AS (SELECT above, count(*) AS n FROM parted WHERE depth > 0 GROUP BY above),
    own_sums AS (
      SELECT p.*, coalesce(k.n, 0) AS n_children,
             CASE WHEN depth > 0 THEN (n_convs - 1) * {_WORDS_SQL.format("node[depth].text")} ELSE 0 END AS saved
      FROM parted p LEFT JOIN kids k ON k.above = p.node),
    spread AS (SELECT node[1:d] AS node, saved, (n_children = 0)::INT AS leaf FROM (SELECT *, unnest(range(depth + 1)) AS d FROM own_sums)),
    sums AS (SELECT node, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM spread GROUP BY node)
    SELECT o.conv_id, o.depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
    FROM own_sums o JOIN sums s ON s.node = o.node LEFT JOIN own_sums u ON u.node = o.above
    """
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = trie.with_borrowed_heads(trie.conversations(table(spark, sf_dir, "conversations")))
    return trie.prefix_trie(convs)


def _sql_field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _sql_tree(name: str, key: str, levels: int) -> str:
    """CTEs name0..: (key, p, h, n, l, r), the nodes of each level with the digests beside them."""
    run = f"PARTITION BY {key}, p // 16 ORDER BY p ROWS BETWEEN"
    out = []
    for i in range(levels):
        rows = f"{name}_in" if i == 0 else f"(SELECT {key}, p // 16 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h, any_value((n + 15) // 16) AS n FROM {name}{i - 1} WHERE n > 1 GROUP BY {key}, p // 16)"
        out.append(
            f"{name}{i} AS (SELECT {key}, p, h, n, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {rows})"
        )
    tops = " UNION ALL ".join(f"SELECT {key}, h AS top FROM {name}{i} WHERE n = 1" for i in range(levels))
    return ", ".join([*out, f"{name}_top AS ({tops})"])


def _sql_climb(rows: str, name: str, key: str, levels: int) -> str:
    """The rows (key, p, folded, proof, ...) with folded and proof carried to the top of their tree."""
    for i in range(levels):
        rows = (
            f"(SELECT x.* EXCLUDE (p, folded, proof), x.p // 16 AS p, CASE WHEN t.n > 1 THEN sha256(t.l || folded || t.r) ELSE folded END AS folded, "
            f"proof || CASE WHEN t.n > 1 THEN t.l || t.r ELSE '' END AS proof FROM {rows} x "
            f"LEFT JOIN {name}{i} t ON t.{key} = x.{key} AND t.p = x.p)"
        )
    return rows


@query(
    f"""
    WITH rows AS (
      SELECT *, coalesce('s' || source, '') AS grp,
             {" || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars"))} AS head, doc_id::VARCHAR AS name FROM documents),
    leaves AS (
      SELECT doc_id, grp, sha256(head || {_sql_field("text")}) AS leaf,
             sha256(head || {_sql_field("CASE WHEN " + _sql_crc32("name") + " % 5 = 0 THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END")}) AS found
      FROM rows),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
    a_in AS (SELECT grp, p, leaf AS h, n FROM placed),
    {_sql_tree("a", "grp", 6)},
    subs AS (SELECT grp, top, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n FROM a_top),
    b_in AS (SELECT 1 AS one, place AS p, top AS h, n FROM subs),
    {_sql_tree("b", "one", 4)},
    low AS (SELECT * FROM {_sql_climb("(SELECT *, found AS folded, '' AS proof FROM placed)", "a", "grp", 6)}),
    middle AS (SELECT low.* EXCLUDE (p), 1 AS one, s.top AS subroot, s.place AS p FROM low JOIN subs s ON s.grp = low.grp),
    high AS (SELECT * FROM {_sql_climb("middle", "b", "one", 4)})
    SELECT doc_id, leaf, subroot, b_top.top AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b_top.top AS verified
    FROM high JOIN b_top ON b_top.one = high.one
    """
)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 5 divides the checksum of the id, the text is found with its A-Z lower-cased."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = merkle.manifest(
        table(spark, sf_dir, "documents"),
        ["doc_id", "source", "lang", "n_chars", "text"],
        tampered={"text": F.translate("text", capitals, capitals.lower())},
        suspect=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
    )
    return found.withColumnRenamed("id", "doc_id")


@query(
    rf"""
    WITH docs AS (
      SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    shingles AS (
      SELECT DISTINCT doc_id, array_to_string(words[i:least(i + 3, len(words))], ' ') AS shingle
      FROM (SELECT *, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i FROM docs WHERE len(words) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
      FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
    either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
      WITH RECURSIVE walk AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT w.a, e.b FROM walk w JOIN either e ON e.a = w.b)
      SELECT a, min(b) AS component_id FROM walk GROUP BY a)
    SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
    FROM docs d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
    """
)
def op13_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosenpath.components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
