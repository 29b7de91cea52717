"""The operators as registered queries over the test tables, and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txquality.llm import decontaminate, interpolated_lm, jaccard_join, kd_shards, language_id, license_scan, line_dedup, pieces, prefix_forest, source_mix, spelling_variants, token_alignment, toxicity
from txquality.llm.shipping import importable

TOKENIZER = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out seventh."""
    docs = _table(spark, sf_dir, "documents")
    return interpolated_lm.score_documents(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later places of repeated three-line windows."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_passages(docs, removed="n_removed")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document and its spans, learned outside the held-out quarter."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = language_id.learn(docs.where(~held_out).select("lang", "text"))
    found = language_id.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    dims = kd_shards.text_dimensions()
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("tie"), *[c.alias(d) for d, c in dims.items()])
    placed = kd_shards.kd_shards(rows, list(dims), shards=16)
    return placed.select("doc_id", "size", F.col("tie").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return prefix_forest.search(vectors, vectors.where("vec_id % 100 = 0"), "vec_id", "embedding")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates of every document."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    """The vocabulary file of the public tokenizers; $LLM_VOCABULARY names another."""
    if given := os.environ.get("LLM_VOCABULARY"):
        return given
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def byte_vocabulary_path() -> str:
    """The byte-level vocabulary of the public tokenizers; $LLM_BYTE_VOCABULARY names another."""
    if given := os.environ.get("LLM_BYTE_VOCABULARY"):
        return given
    import public_tokenizers

    return public_tokenizers.path(BYTE_TOKENIZER)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding them gives the text again."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.encoded(docs, pieces.load(vocabulary_path()), round_trip="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select("doc_id", "severity", "p_toxic", toxicity.rejected().alias("rejected"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that link at 90 % of their three-word shingles."""
    return jaccard_join.components(_table(spark, sf_dir, "documents"), 3, (9, 10))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold benchmark items, with changed values or without."""
    return decontaminate.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's tokens under two public vocabularies."""
    return token_alignment.alignment(_table(spark, sf_dir, "documents"), token_alignment.load(byte_vocabulary_path(), vocabulary_path()))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, form and root."""
    found = spelling_variants.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of one and a half times all words takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = source_mix.mix_drawn(source_mix.with_quality(source_mix.drawn(docs), _table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "epochs")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_interpolated_lm, op2_line_dedup, op3_language_id, op4_kd_shards, op5_prefix_forest, op6_license_scan, op7_sentencepiece, op8_toxicity, op9_jaccard_join, op10_decontaminate, op11_token_alignment, op12_spelling_variants, op13_source_mix, pipeline)}


def oracle() -> dict[str, str]:
    return SQL | {"op6_license_scan": _license_sql()}


def _license_sql() -> str:
    """Every alignment of every template with every text, by a join on words."""
    heads, words = [], []
    for number, (label, base, text, phrase) in enumerate(license_scan.TEMPLATES):
        template, key = text.split(), phrase.split()
        start = next(i for i in range(len(template)) if template[i : i + len(key)] == key)
        heads.append(f"({number}, '{label}', {str(base).lower()}, {len(template)}, {start}, {len(key)})")
        words += [f"({number}, {i}, '{w}')" for i, w in enumerate(template)]
    upper = "".join(map(chr, range(65, 91)))
    return f"""
        with texts as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws
            from documents
        ), words as (
            select d.doc_id, t.w, t.i - 1 as i from texts d, unnest(d.ws) with ordinality as t(w, i)
        ), heads(number, label, base, size, key_start, key_size) as (values {", ".join(heads)}),
        parts(number, j, w) as (values {", ".join(words)}),
        aligned as (
            select w.doc_id, h.label, h.base, w.i - p.j as start, count(*) as held, any_value(h.size) as size,
                   count(*) filter (where p.j between h.key_start and h.key_start + h.key_size - 1) as key_held, any_value(h.key_size) as key_size
            from words w join parts p on p.w = w.w join heads h on h.number = p.number
            group by w.doc_id, h.number, h.label, h.base, w.i - p.j
        ), found as (
            select doc_id, label, base, start, held / size as share from aligned
            where key_held = key_size and held / size >= {license_scan.FOUND_SHARE}
        )
        select t.doc_id, len(t.ws) as n_words, count(f.start) filter (where f.base) as n_base,
               min(f.start) filter (where f.base) as first_word, max(f.start) filter (where f.base) as last_word,
               coalesce(string_agg(distinct f.label, ',' order by f.label) filter (where f.base), '') as base_labels,
               coalesce(string_agg(distinct f.label, ',' order by f.label), '') as labels, coalesce(max(f.share), 0.0) as score
        from texts t left join found f on f.doc_id = t.doc_id group by t.doc_id, t.ws"""


# the closed form of the shared targets: with sources by cap over weight, the first that its rate does not fill ends the search
MIX_SQL = """
        with quality as (
            select doc_id, avg(quality) as quality from labels where doc_id is not null group by doc_id
        ), drawn as (
            select d.doc_id, d.source, d.text, len(regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
                   -ln((('0x' || substr(md5(coalesce(cast(d.doc_id as varchar), '') || ':' || coalesce(d.text, '')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
                   / coalesce(pow(4.0::double, q.quality - 0.5), 1.0::double) as draw
            from documents d left join quality q on q.doc_id = d.doc_id
        ), sizes as (
            select source, sum(size)::bigint as source_size from drawn group by source
        ), weighed as (
            select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end::double as w, 2.0::double * source_size as cap from sizes
        ), rated as (
            select *, (1.5::double * sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, source rows between unbounded preceding and 1 preceding), 0))
                   / sum(w) over (order by cap / w, source rows between current row and unbounded following) as rate
            from weighed
        ), targets as (
            select source, source_size, least(cap, w * (select max(r.rate) from rated r where r.rate * r.w <= r.cap)) as target from rated
        ), budgets as (
            select *, case when source_size > 0 then floor(target + 0.5)::bigint // source_size else 0 end as epochs from targets
        ), ordered as (
            select d.*, b.source_size, b.target, b.epochs, floor(b.target + 0.5)::bigint - b.epochs * b.source_size as rest,
                   coalesce(sum(d.size) over (partition by d.source order by d.draw, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as before
            from drawn d join budgets b on b.source is not distinct from d.source
        )
        select doc_id, size::bigint as size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::bigint as taken, source, epochs::bigint as epochs from ordered"""

SQL: dict[str, str] = {
    "op13_source_mix": MIX_SQL,
    "op2_line_dedup": """
        with lines as (
            select d.doc_id, d.text, t.i, t.line
            from documents d, unnest(string_split(d.text, chr(10))) with ordinality as t(line, i)
        ), solid as (
            select doc_id, i, trim(line) as line, row_number() over (partition by doc_id order by i) as k
            from lines where trim(line) <> ''
        ), windows as (
            select doc_id, k, line || chr(10) || lead(line, 1) over w || chr(10) || lead(line, 2) over w as body
            from solid window w as (partition by doc_id order by k)
        ), placed as (
            select doc_id, k, row_number() over (partition by body order by doc_id, k) as place
            from windows where body is not null
        ), gone as (
            select distinct s.doc_id, s.i from placed p join solid s on s.doc_id = p.doc_id and s.k between p.k and p.k + 2
            where p.place > 1
        )
        select d.doc_id,
               case when d.text is null then null
                    else coalesce(string_agg(l.line, chr(10) order by l.i) filter (where g.i is null), '') end as text,
               count(g.i) as n_removed
        from documents d left join lines l on l.doc_id = d.doc_id
        left join gone g on g.doc_id = l.doc_id and g.i = l.i
        group by d.doc_id, d.text""",
}
