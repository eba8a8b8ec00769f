"""Registry of the engine's own queries and their SQL oracles, over corpora derived from the given tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import corpus, schemas
from .functions import scalars as S
from .operators import abbreviations, caselaw, graph, legislation, lookup, oblique, provisions, replacing, rules
from .plans import enrich
from .session import map_rows, shared_folder, stored
from .sources import documents, log, readers, writers
from .streaming import attempts, messages

# -- a small rule manifest, in the documented format -----------------------------------


def _tokens(*spec: str) -> str:
    kinds = {"#": {"LIKE_NUM": "true"}, "dddd": {"SHAPE": "dddd"}}
    return json.dumps([kinds.get(t, {"ORTH": t}) for t in spec])


#: The manifest's columns. id, family, uri_template, canonical_form, match_example, citation_type, is_canonical, is_neutral, tokens
RULES = [
    ("uksc", "UKSC", "http://cases.example/uksc/year/d1", "[dddd] UKSC d+", "[2022] UKSC 12", "NCitYearAbbrNum", True, True, ("[", "dddd", "]", "UKSC", "#")),
    ("uksc_a", "UKSC", "http://cases.example/uksc/year/d1", "[dddd] UKSC d+", "(2022) UKSC 12", "NCitYearAbbrNum", False, True, ("(", "dddd", ")", "UKSC", "#")),
    ("ewhc_ch", "EWHC", "http://cases.example/ewhc/ch/year/d1", "[dddd] EWHC d+ (Ch)", "[2022] EWHC 12 (Ch)", "NCitYearAbbrNumDiv", True, True, ("[", "dddd", "]", "EWHC", "#", "(", "Ch", ")")),
    ("ewhc_ch_a", "EWHC", "http://cases.example/ewhc/ch/year/d1", "[dddd] EWHC d+ (Ch)", "(2022) EWHC 12 (Ch)", "NCitYearAbbrNumDiv", False, True, ("(", "dddd", ")", "EWHC", "#", "(", "Ch", ")")),
    ("wlr", "WLR", None, "[dddd] d1 WLR d2", "[2022] 1 WLR 123", "PubYearNumAbbrNum", True, False, ("[", "dddd", "]", "#", "WLR", "#")),
    ("wlr_a", "WLR", None, "[dddd] d1 WLR d2", "[2022] 1 W.L.R. 123", "PubYearNumAbbrNum", False, False, ("[", "dddd", "]", "#", "W.L.R.", "#")),
    ("eucase", "EUC", None, "Case C-d1/d2", "Case C-123/12", "EUCCase", True, False, ("Case", "C-#")),
    ("pd", "PD", None, "d1 PD d2", "1 PD 123", "PubNumAbbrNum", True, False, ("#", "PD", "#")),
]


def manifest(spark: SparkSession) -> DataFrame:
    rows = []
    for i, family, uri, form, example, kind, canonical, neutral, spec in RULES:
        pattern = json.loads(_tokens(*spec))
        if "C-#" in spec:  # one token, such as C-123/12: a prefix and a number
            pattern = [{"ORTH": "Case"}, {"SHAPE": "C-number"}]
        rows.append((i, family, family, uri, form, example, example, kind, canonical, neutral, "UK", json.dumps({"id": i, "description": family, "label": "CITATION", "pattern": pattern})))
    return spark.createDataFrame(rows, schemas.MANIFEST)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs as documents (uri, text) without tags."""
    p = corpus.paragraphs(spark, sf_dir)
    return p.select(F.concat_ws("#", "uri", F.col("para_no").cast("string")).alias("uri"), F.regexp_replace("markup", "<[^>]+>", "").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


P = f"with p as ({corpus.PARAGRAPHS}), t as (select *, concat_ws('#', uri, cast(para_no as varchar)) as id, regexp_replace(markup, '<[^>]+>', '', 'g') as text from p)"
A = f"with a as ({corpus.ACTS})"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


# -- case law ---------------------------------------------------------------------------


@query(
    P
    + """
select id as uri, 'uksc' as family, concat('[', case_year, '] UKSC ', part) as citation_match, concat('[', case_year, '] UKSC ', part) as corrected_citation, case_year as year, concat('http://cases.example/uksc/', case_year, '/', part) as case_uri, true as is_neutral from t where kind = 0
union all select id, 'ewhc', concat('(', case_year, ') EWHC ', part, ' (Ch)'), concat('[', case_year, '] EWHC ', part, ' (Ch)'), case_year, concat('http://cases.example/ewhc/ch/', case_year, '/', part), true from t where kind = 1
union all select id, 'wlr', concat('[', case_year, '] 1 W.L.R. ', part), concat('[', case_year, '] 1 WLR ', part), case_year, '#', false from t where kind = 2
union all select id, 'euc', concat('Case C-', part, '/12'), concat('Case C-', part, '/12'), '', '#', false from t where kind = 2"""
)
def caselaw_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caselaw.citations(texts(spark, sf_dir), manifest(spark)).select("uri", "family", "citation_match", "corrected_citation", "year", "case_uri", "is_neutral")


@query(
    P
    + """ , h as (select id, text, concat('[', case_year, '] UKSC ', part) as m, 'uksc' as rule_id from t where kind = 0 union all select id, text, concat('(', case_year, ') EWHC ', part, ' (Ch)'), 'ewhc_ch_a' from t where kind = 1
 union all select id, text, concat('[', case_year, '] 1 W.L.R. ', part), 'wlr_a' from t where kind = 2 union all select id, text, concat('Case C-', part, '/12'), 'eucase' from t where kind = 2)
 select id as uri, cast(strpos(text, m) - 1 as int) as start, cast(strpos(text, m) - 1 + length(m) as int) as "end", m as citation_match, rule_id from h"""
)
def entity_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as a table function, in SQL alone."""
    rules.register(spark, manifest(spark))
    texts(spark, sf_dir).createOrReplaceTempView("statuta_texts")
    return spark.sql("select t.uri, h.start, h.end, h.citation_match, h.rule_id from statuta_texts t, lateral entity_spans(t.text) h")


_KINDS = """case l_linenumber % 4 when 0 then 'PubYearAbbrNum' when 1 then 'PubYearNumAbbrNum' when 2 then 'PubNumAbbrNum' else 'Unknown' end"""


@query(
    f"""select l_orderkey, l_linenumber, l_partkey, {_KINDS} as kind,
 case l_linenumber % 4 when 0 then concat('[', year(l_shipdate), '] PNLR ', l_partkey) when 1 then concat('(', year(l_shipdate), ') ', l_suppkey, ' Cr App R ', l_partkey)
   when 2 then concat(l_suppkey, ' ExD ', l_partkey) else null end as corrected_citation,
 case when l_linenumber % 4 in (0, 1) then cast(year(l_shipdate) as varchar) when l_linenumber % 4 = 2 then '' when l_linenumber % 4 = 3 then '' end as year
 from lineitem"""
)
def malformed_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    y, s, p = F.year("l_shipdate").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string")
    d = d.withColumn("kind", F.expr(_KINDS))
    match = F.when(F.col("kind") == "PubYearAbbrNum", F.concat(F.lit("["), y, F.lit("] P.N.L.R "), p)).when(F.col("kind") == "PubYearNumAbbrNum", F.concat(F.lit("("), y, F.lit(") "), s, F.lit(" Cr. App. R. "), p)).otherwise(F.concat(s, F.lit(" Ex.D. "), p))
    form = F.when(F.col("kind") == "PubYearAbbrNum", F.lit("[dddd] PNLR d+")).when(F.col("kind") == "PubYearNumAbbrNum", F.lit("(dddd) d1 Cr App R d2")).otherwise(F.lit("d1 ExD d2"))
    d = d.withColumn("m", match).withColumn("form", form)
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "kind", S.corrected_citation(F.col("kind"), F.col("m"), F.col("form")).alias("corrected_citation"), S.citation_parts(F.col("kind"), F.col("m"))[0].alias("year"))


#: A rule for every nation, as a court; some have an example of another form, some share their pattern with the rule before. Spark and DuckDB both run it.
_COURTS = """select concat('court_', lpad(cast(n_nationkey as string), 2, '0')) as id, family, name as description,
 concat('http://cases.example/', n_nationkey, '/year/d1') as uri_template, concat('[dddd] ', name, ' d+') as canonical_form, concat('[2022] ', name, ' ', n_nationkey + 1) as canonical_example,
 case when n_nationkey % 5 = 3 then concat('(2022) ', name, ' ', n_nationkey + 1) else concat('[2022] ', name, ' ', n_nationkey + 1) end as match_example,
 'NCitYearAbbrNum' as citation_type, n_nationkey % 2 = 0 as is_canonical, true as is_neutral, 'UK' as jurisdiction,
 concat('{"id": "', concat('court_', lpad(cast(n_nationkey as string), 2, '0')), '", "label": "CITATION", "pattern": [{"ORTH": "["}, {"SHAPE": "dddd"}, {"ORTH": "]"}, {"ORTH": "', name, '"}, {"LIKE_NUM": "true"}]}') as pattern
 from (select *, replace(concat(upper(substr(n_name, 1, 6)), 'X', cast(case when n_nationkey % 7 = 6 then n_nationkey - 1 else n_nationkey end as string)), ' ', '') as name
  from (select n_nationkey, n_name as family, case when n_nationkey % 7 in (5, 6) then 'SHARED' else n_name end as n_name from nation) z) y"""
_FOUND = f"(select id, case when n % 5 = 3 then null when n % 7 = 6 then concat('court_', lpad(cast(n - 1 as varchar), 2, '0')) else id end as found_id from (select id, cast(substr(id, 7) as int) as n from ({_COURTS})))"


def _courts(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir, "nation")
    columns = schemas.MANIFEST.replace(", ", ",").split(",")
    return spark.sql(_COURTS).select(*[F.col(c.split(" ")[0]).cast(c.split(" ")[1]) for c in columns])


@query(f"select id, found_id, coalesce(found_id = id, false) as passed from {_FOUND}")
def manifest_self_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that their own examples don't find, and rules whose examples another one finds."""
    return rules.self_test(_courts(spark, sf_dir))


@query(f"select count(*) as rules, count(distinct found_id) as distinct_found, count(*) = count(distinct found_id) as ok from {_FOUND}")
def manifest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.publishable(_courts(spark, sf_dir))


@query("""select l_orderkey, l_linenumber, l_partkey,
 case l_linenumber % 3 when 0 then concat('u/', year(l_shipdate), '/', l_suppkey) when 1 then concat('u/', year(l_shipdate), '/', l_suppkey, '_', l_partkey) else '#' end as uri from lineitem""")
def uri_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "lineitem")
    k = F.col("l_linenumber") % 3
    # a template that names both numbers fills the first only, so the second is written by one that names d2 alone
    template = F.when(k == 0, F.lit("u/year/d1")).when(k == 1, F.concat(F.lit("u/year/"), F.col("l_suppkey").cast("string"), F.lit("_d2")))
    uri = S.create_uri(template, F.year("l_shipdate").cast("string"), F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", uri.alias("uri"))


# -- the lookup table ----------------------------------------------------------------------

_ENHANCED = """, u as (select *, unnest([title, shorttitle, acronymcitation]) as candidate_titles from a),
e as (select *, regexp_matches(candidate_titles, 'Act\\s+(\\d{4})') as for_fuzzy from u where candidate_titles is not null
      qualify row_number() over (partition by candidate_titles order by ref, acronymcitation nulls last, citation, shorttitle nulls last, title, year) = 1)"""


def _lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.enhance(corpus.acts(spark, sf_dir))


@query(A + _ENHANCED + " select ref, year, citation, candidate_titles, for_fuzzy from e")
def lookup_enhance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir).select("ref", "year", "citation", "candidate_titles", "for_fuzzy")


@query(A + " select ref, year, citation, title, shorttitle, acronymcitation from (select * from a where year <= 1996 union select * from a where year >= 1995)")
def lookup_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = corpus.acts(spark, sf_dir)
    return lookup.merged(a.where("year <= 1996"), a.where("year >= 1995")).select("ref", "year", "citation", "title", "shorttitle", "acronymcitation")


_TRIPLES = """
select concat('s/', s_suppkey) as s, 'type' as p, case when s_suppkey % 5 = 0 then 'other' else 'act' end as o from supplier
union all select concat('s/', s_suppkey), 'title', s_name from supplier
union all select concat('s/', s_suppkey), 'ref_version', concat('v', s_nationkey) from supplier where s_suppkey % 7 <> 0
union all select concat('s/', s_suppkey), 'act_time', concat('2024-01-', lpad(cast(s_nationkey % 28 + 1 as string), 2, '0')) from supplier
union all select concat('s/', s_suppkey), 'year', cast(1990 + s_nationkey as string) from supplier where s_suppkey % 2 = 0
union all select concat('s/', s_suppkey), 'citation', concat('c. ', s_suppkey) from supplier where s_suppkey % 3 = 0"""


@query("""select concat('s/', s_suppkey) as ref, s_name as title, concat('v', s_nationkey) as ref_version,
 case when s_suppkey % 3 = 0 then concat('c. ', s_suppkey) end as citation, case when s_suppkey % 2 = 0 then cast(1990 + s_nationkey as varchar) end as year
 from supplier where s_suppkey % 5 <> 0 and s_suppkey % 7 <> 0""")
def triple_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir, "supplier")
    return lookup.from_triples(spark.sql(_TRIPLES)).select("ref", "title", "ref_version", "citation", "year")


@query("""select concat('s/', s_suppkey) as ref, 1990 + s_nationkey as year from supplier where s_suppkey % 5 <> 0 and s_suppkey % 7 <> 0 and s_suppkey % 2 = 0 and s_nationkey between 5 and 15""")
def backfill_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir, "supplier")
    return lookup.by_year(spark.sql(_TRIPLES), 1995, 2005).select("ref", F.col("year").cast("int").alias("year"))


@query("""select concat('s/', s_suppkey) as ref, concat('2024-01-', lpad(cast(s_nationkey % 28 + 1 as varchar), 2, '0')) as act_time from supplier
 where s_suppkey % 5 <> 0 and s_suppkey % 7 <> 0 and s_nationkey % 28 + 1 between 11 and 19""")
def changed_acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir, "supplier")
    return lookup.changed_since(lookup.from_triples(spark.sql(_TRIPLES)), 10, F.lit("2024-01-20").cast("date")).select("ref", "act_time")


# -- statutes ---------------------------------------------------------------------------------


@query(P + ", a as (" + corpus.ACTS + ")" + _ENHANCED + r" select candidate_titles, year from e where year in (select cast(unnest(regexp_extract_all(text, '\b\d{4}\b')) as bigint) from t)")
def year_semijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legislation.candidate_titles(texts(spark, sf_dir), _lookup(spark, sf_dir)).select("candidate_titles", "year")


@query(P + r" select distinct id as uri, cast(y as bigint) as year from (select id, unnest(regexp_extract_all(text, '\b\d{4}\b')) as y from t)")
def document_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legislation.document_years(texts(spark, sf_dir))


#: What exact_titles adds to each text: titles inside words, which don't count, one that stands twice, and one that begins another.
_NEAR_WORDS = "concat(text, ' Not XCA ', act_year, ' nor CA ', act_year, 'x, but CA ', act_year, '; CA ', act_year, ' too. See The Parts Order No. ', part, ' and Schedule ', line, '.')"


@query(
    P
    + ", a as ("
    + corpus.ACTS
    + ")"
    + _ENHANCED
    + f""", z as (select id, x, unnest(list_distinct(regexp_extract_all(x, '\\b\\d{{4}}\\b'))) as y from (select id, {_NEAR_WORDS} as x from t)),
 h as (select id, candidate_titles as title, ref, citation, unnest(list_filter(generate_series(1, length(x)), lambda i: substr(x, i, length(candidate_titles)) = candidate_titles
   and not regexp_matches(case when i > 1 then substr(x, i - 1, 1) else '' end, '\\w') and not regexp_matches(substr(x, i + length(candidate_titles), 1), '\\w'))) as i
  from z join e on cast(e.year as varchar) = y and contains(x, candidate_titles))
 select id as uri, title, cast(i - 1 as int) as start, cast(i - 1 + length(title) as int) as "end", 100 as confidence, ref as href, citation as canonical from h"""
)
def exact_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = corpus.paragraphs(spark, sf_dir)
    t = p.select(F.concat_ws("#", "uri", F.col("para_no").cast("string")).alias("uri"), F.regexp_replace("markup", "<[^>]+>", "").alias("text"), "act_year", "part", "line")
    return legislation.exact_hits(t.select("uri", F.expr(_NEAR_WORDS).alias("text")), _lookup(spark, sf_dir)).select("uri", "title", "start", "end", "confidence", "href", "canonical")


@query(
    r"""select d.doc_id as uri, phrase from documents d join (select distinct regexp_extract(text, '^([A-Za-z]+ [A-Za-z]+)', 1) as phrase from benchmark) b
 on b.phrase <> '' and regexp_matches(d.text, '(^|[^\p{L}\p{N}])' || b.phrase || '($|[^\p{L}\p{N}])')"""
)
def phrase_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = table(spark, sf_dir, "benchmark").select(F.regexp_extract("text", "^([A-Za-z]+ [A-Za-z]+)", 1).alias("phrase")).distinct().where("phrase <> ''")
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("uri"), "text")
    found = legislation.phrase_hits(docs.withColumn("uri", F.col("uri").cast("string")), phrases)
    return found.select(F.col("uri").cast("bigint").alias("uri"), "phrase").distinct()


@query(
    P
    + """, f as (select id, replace(text, 'Companies Act', 'Compannies Act') as x, concat('Compannies Act ', act_year) as m, concat('Companies Act ', act_year) as title, 97 as score from t where kind in (2, 3)
  union all select id, text, concat('Finance Act ', act_year), concat('Finance Act ', act_year), 100 from t where kind = 0)
 select id as uri, title, cast(strpos(x, m) - 1 as int) as start, cast(strpos(x, m) - 1 + length(m) as int) as "end", score as confidence, m as detected_ref from f"""
)
def fuzzy_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = texts(spark, sf_dir).withColumn("text", F.replace("text", F.lit("Companies Act"), F.lit("Compannies Act")))
    return legislation.fuzzy_hits(d, _lookup(spark, sf_dir)).select("uri", "title", "start", "end", "confidence", "detected_ref")


_HITS = """select cast(l_orderkey as string) as uri, cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) as int) as idx,
 cast(l_partkey % 30 as int) as start, cast(l_partkey % 30 + l_suppkey % 20 as int) as {end}, cast(l_quantity as int) as confidence from lineitem"""


@query(
    "with h as ("
    + _HITS.format(end='"end"')
    + """) select * from h where not exists (select 1 from h o where o.uri = h.uri and o.idx <> h.idx
  and ((h.start >= o.start and h."end" <= o."end") or (o.start >= h.start and o."end" <= h."end"))
  and (h.confidence < o.confidence or (h.confidence = o.confidence and h.idx < o.idx)))"""
)
def overlap_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir)
    return legislation.resolve_overlaps(spark.sql(_HITS.format(end="end"))).select("uri", "idx", "start", "end", "confidence")


@query(
    P
    + """ select id as uri, concat('Companies Act ', act_year) as detected_ref, concat('http://statutes.example/', act_year, '/2') as href from t where kind in (2, 3)
 union all select id, concat('CA ', act_year), concat('http://statutes.example/', act_year, '/2') from t where kind = 2
 union all select id, concat('Finance Act ', act_year), concat('http://statutes.example/', act_year, '/1') from t where kind = 0"""
)
def statute_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legislation.matches(texts(spark, sf_dir), _lookup(spark, sf_dir)).select("uri", "detected_ref", "href")


@query(
    P
    + """ , h as (select id, concat('Companies Act ', act_year) as title, 1 as pass, strpos(text, concat('Companies Act ', act_year)) - 1 as start from t where kind in (2, 3)
 union all select id, concat('CA ', act_year), 0, strpos(text, concat('CA ', act_year)) - 1 from t where kind = 2
 union all select id, concat('Finance Act ', act_year), 1, strpos(text, concat('Finance Act ', act_year)) - 1 from t where kind = 0)
 select id as uri, title, string_agg(concat(pass, ':', start), ',' order by pass, start) as places from h group by id, title"""
)
def title_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits by document and title: exact ones first, then fuzzy ones, in order."""
    found = legislation.by_title(legislation.matches(texts(spark, sf_dir), _lookup(spark, sf_dir)))
    return found.select("uri", "title", F.array_join(F.transform("hits", lambda x: F.concat_ws(":", x["pass"].cast("string"), x["start"].cast("string"))), ",").alias("places"))


# -- indirect mentions and sections --------------------------------------------------------------

_M = ", m as (select uri, para_no as m_para, concat('Finance Act ', act_year) as detected_leg, concat('http://statutes.example/', act_year, '/1') as href, act_year from p where kind = 0)"


@query(P + _M + " select u.uri, para_no as para, cast(strpos(markup, 'the Act') - 1 as int) as start, detected_leg, href, m_para from p u join m on m.uri = u.uri and m_para < para_no where kind = 1 qualify row_number() over (partition by u.uri, para_no order by m_para desc) = 1")
def oblique_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, found = oblique.both(corpus.paragraphs(spark, sf_dir))
    return oblique.latest_before(used.where("kind = 'act'"), found).select("uri", "para", "start", "detected_leg", "href", "m_para")


@query(P + _M + " select u.uri, para_no as para, concat('the ', u.act_year, ' Act') as detected_ref, detected_leg, href, m_para from p u join m on m.uri = u.uri and m.act_year = u.act_year and m_para <= para_no where kind = 1 qualify row_number() over (partition by u.uri, para_no order by m_para) = 1")
def oblique_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    used, found = oblique.both(corpus.paragraphs(spark, sf_dir))
    return oblique.first_of_year(used.where("kind = 'numbered_act'"), found).select("uri", "para", "detected_ref", "detected_leg", "href", "m_para")


@query(P + " select uri, para_no as para, concat('section ', sec, '(', line, ')') as section, sec as section_no, cast(strpos(markup, '<ref') - strpos(markup, 'section ') - length(concat('section ', sec, '(', line, ')')) as int) as gap, concat('http://statutes.example/', act_year, '/1/section/', sec) as section_href, concat(act_year, ' c. 1 s. ', sec) as section_canonical from p where kind = 0")
def provision_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = provisions.paired(corpus.paragraphs(spark, sf_dir))
    return pairs.select("uri", "para", "section", "section_no", "gap", S.section_href(F.col("href"), F.col("section_no")).alias("section_href"), S.section_canonical(F.col("canonical"), F.col("section_no")).alias("section_canonical"))


@query(
    P
    + """, u as (select uri, para_no, sec, case when kind = 0 then concat('section ', sec, '(', line, ')') else concat('section ', sec) end as section, case when kind = 0 then concat('/', line) else '' end as sub from p where kind <> 2),
 d as (select uri, para_no as d_para, sec, concat('http://statutes.example/', act_year, '/1/section/', sec) as href from p where kind = 0)
 select u.uri, para_no as para, section, d_para, concat(href, sub) as section_href from u join d on d.uri = u.uri and d.sec = u.sec and d_para <= para_no
 qualify row_number() over (partition by u.uri, para_no order by d_para desc) = 1"""
)
def provision_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provisions.resolved(corpus.paragraphs(spark, sf_dir)).select("uri", "para", "section", "d_para", "section_href")


@query(P + " select uri, para_no as para, cast(strpos(markup, 'section ') - 1 as int) as start, case when kind = 0 then concat('section ', sec, '(', line, ')') else concat('section ', sec) end as section, sec as section_no from p where kind <> 2")
def section_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provisions.sections(corpus.paragraphs(spark, sf_dir)).select("uri", "para", "start", "section", "section_no")


# -- abbreviations ---------------------------------------------------------------------------------


@query(P + " select id as uri, 'CED' as abb_match, 'Customs and Excise Duties' as longform from t where kind = 2 union all select id, concat('CA ', act_year), concat('Companies Act ', act_year) from t where kind = 2")
def abbreviation_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abbreviations.definitions(texts(spark, sf_dir)).select("uri", "abb_match", "longform")


@query(P + " select id as uri, 'CED' as abb_match, cast(strpos(text, 'CED') - 1 as int) as start from t where kind = 2 union all select id, concat('CA ', act_year), cast(strpos(text, concat('CA ', act_year)) - 1 as int) from t where kind = 2")
def abbreviation_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = texts(spark, sf_dir)
    return abbreviations.occurrences(t, abbreviations.definitions(t)).select("uri", "abb_match", "start")


# -- replacements --------------------------------------------------------------------------------------


@query(
    f"""with c as ({ORACLE_SQL["caselaw_citations"]}), s as ({ORACLE_SQL["statute_matches"]}), a as ({ORACLE_SQL["abbreviation_definitions"]})
 select distinct uri, 'case' as kind, citation_match as f0, corrected_citation as f1, year as f2, case_uri as f3, cast(is_neutral as varchar) as f4 from c
 union all select distinct uri, 'leg', detected_ref, href, concat(regexp_extract(href, '(\\d+)/\\d+$', 1), ' c. ', regexp_extract(href, '(\\d+)$', 1)), null, null from s
 union all select distinct uri, 'abb', abb_match, longform, null, null, null from a"""
)
def replacement_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three annotators find, written as lines and read back."""
    found = enrich.replacements(texts(spark, sf_dir), manifest(spark), _lookup(spark, sf_dir))
    back = replacing.decoded(replacing.encoded(found))
    return back.select("uri", "kind", *[F.get("fields", F.lit(k)).alias(f"f{k}") for k in range(5)])


#: Paragraphs with their case, statute and abbreviation tags, as the first stage writes them.
_CASE = "concat('<ref uk:type=\"case\" href=\"', {href}, '\" uk:isNeutral=\"{neutral}\" uk:canonical=\"', {canonical}, '\"', {year}, ' uk:origin=\"OWN\">', {text}, '</ref>')"
_LEG = "concat('<ref uk:type=\"legislation\" href=\"http://statutes.example/', act_year, '/{n}\" uk:canonical=\"', act_year, ' c. {n}\" uk:origin=\"OWN\">{title} ', act_year, '</ref>')"
_YEAR = "concat(' uk:year=\"', case_year, '\"')"
_TAGS = {
    "uksc": _CASE.format(href="concat('http://cases.example/uksc/', case_year, '/', part)", neutral="true", canonical="concat('[', case_year, '] UKSC ', part)", year=_YEAR, text="concat('[', case_year, '] UKSC ', part)"),
    "ewhc": _CASE.format(href="concat('http://cases.example/ewhc/ch/', case_year, '/', part)", neutral="true", canonical="concat('[', case_year, '] EWHC ', part, ' (Ch)')", year=_YEAR, text="concat('(', case_year, ') EWHC ', part, ' (Ch)')"),
    "wlr": _CASE.format(href="'#'", neutral="false", canonical="concat('[', case_year, '] 1 WLR ', part)", year=_YEAR, text="concat('[', case_year, '] 1 W.L.R. ', part)"),
    "euc": _CASE.format(href="'#'", neutral="false", canonical="concat('Case C-', part, '/12')", year="''", text="concat('Case C-', part, '/12')"),
    "finance": _LEG.format(n=1, title="Finance Act"),
    "companies": _LEG.format(n=2, title="Companies Act"),
    "ca": _LEG.format(n=2, title="CA"),
    "ced": "'<abbr title=\"Customs and Excise Duties\" uk:origin=\"OWN\">CED</abbr>'",
}
#: Kind by kind; what is put in braces differs between the stages.
_SPLICED = """case kind
  when 0 then concat('<p>As held in ', {uksc}, ', ', {section0}, ' of the ', {finance}, ' applies.</p>')
  when 1 then concat('<p>Under ', {the_act}, ' and ', {section1}, ' the claim ', {ewhc}, ' failed; ', {numbered}, ' is not in point.</p>')
  when 2 then concat('<p>The Customs and Excise Duties ("', {ced}, '") and ', {companies}, ' ("', {ca}, '") were cited in ', {wlr}, ' and ', {euc}, '.</p>')
  else concat('<p>Then ', {section3}, ' of it and the ', {companies}, '.</p>') end"""
_UNTOUCHED = {"section0": "concat('section ', sec, '(', line, ')')", "section1": "concat('section ', sec)", "section3": "concat('section ', sec)", "the_act": "'the Act'", "numbered": "concat('the ', act_year, ' Act')"}


@query(P + " select id as uri, concat('<judgment><header>Companies Act ', act_year, '</header><content>', " + _SPLICED.format(**_TAGS, **_UNTOUCHED) + ", '</content></judgment>') as xml from t")
def splice_first_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph a document, with what the three annotators find in it; the header is left alone."""
    p = corpus.paragraphs(spark, sf_dir)
    plain = F.regexp_replace("markup", "</?ref[^>]*>", "")
    xml = F.concat(F.lit("<judgment><header>Companies Act "), "act_year", F.lit("</header><content>"), plain, F.lit("</content></judgment>"))
    docs = p.select(F.concat_ws("#", "uri", F.col("para_no").cast("string")).alias("uri"), xml.alias("xml"))
    return enrich.first_stage(docs, manifest(spark), _lookup(spark, sf_dir), search=False)


@query(
    P
    + _M
    + """, o as (select u.uri, para_no, href, m.act_year as leg_year from p u join m on m.uri = u.uri and m_para < para_no where kind = 1 qualify row_number() over (partition by u.uri, para_no order by m_para desc) = 1),
 x as (select p.uri, p.para_no, case when href is null then markup else replace(markup, 'the Act', concat('<ref href="', href, '" uk:canonical="', leg_year, ' c. 1" uk:type="legislation" uk:origin="OWN">the Act</ref>')) end as markup
  from p left join o on o.uri = p.uri and o.para_no = p.para_no)
 select uri, concat('<judgment>', string_agg(markup, '' order by para_no), '</judgment>') as xml from x group by uri"""
)
def splice_second_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stored(corpus.paragraphs(spark, sf_dir), "paragraphs")
    docs = p.groupBy("uri").agg(F.concat(F.lit("<judgment>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_no", "markup"))), lambda x: x["markup"]), ""), F.lit("</judgment>")).alias("xml"))
    found = oblique.latest_before(oblique.uses(p).where("kind = 'act'"), oblique.mentions(p))
    return replacing.splice_second_stage(docs, replacing.section_tags(found))


# -- documents -------------------------------------------------------------------------------------------


@query("""select page_id, case when page_id % 3 = 0 then concat('A', page_id) when page_id % 3 = 1 then 'B' else '' end as before_header, case page_id % 3 when 0 then '</header>' when 1 then '<header/>' else '' end as tag, url as after_header from pages""")
def body_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "pages")
    k = F.col("page_id") % 3
    xml = F.when(k == 0, F.concat(F.lit("A"), F.col("page_id").cast("string"), F.lit("</header>"), "url")).when(k == 1, F.concat(F.lit("B<header/>"), "url")).otherwise(F.col("url"))
    before, tag, after = S.header_split(xml)
    return d.select("page_id", before.alias("before_header"), tag.alias("tag"), after.alias("after_header"))


@query(r"""select page_id, cast(k - 1 as int) as para_no, l[k] as markup from (select page_id, regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?/>|<p(?:\s[^>]*)?>.*?</p\s*>') as l from pages), unnest(generate_series(1, len(l))) g(k)""")
def paragraph_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("uri"), F.col("html").alias("xml"))
    return replacing.paragraph_rows(d).select(F.col("uri").cast("bigint").alias("page_id"), "para_no", "markup")


@query(
    """with d as (select doc_id, concat('<p>in ', coalesce(source, ''), '</p>') as inner_ from documents)
 select doc_id, 0 as para_no, concat('<p a="x > y">', doc_id, inner_, '<![CDATA[</p><p>]]></p>') as markup from d union all select doc_id, 1, inner_ from d union all select doc_id, 2, '<p/>' from d
 union all select doc_id, 3, '<p >new <!-- </p> --> tail</p >' from d"""
)
def paragraph_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs inside each other, and tags in comments, CDATA sections, instructions and attributes, which aren't tags."""
    d = table(spark, sf_dir, "documents")
    inner = F.concat(F.lit("<p>in "), F.coalesce("source", F.lit("")), F.lit("</p>"))
    xml = F.concat(F.lit('<d><!-- <p>no</p> --><?p <p> ?><p a="x > y">'), F.col("doc_id").cast("string"), inner, F.lit("<![CDATA[</p><p>]]></p><p/><pre>no</pre><p >new <!-- </p> --> tail</p ></d>"))
    return replacing.paragraph_rows(d.select(F.col("doc_id").cast("string").alias("uri"), xml.alias("xml"))).select(F.col("uri").cast("bigint").alias("doc_id"), "para_no", "markup")


#: Own refs inside each other, a foreign one, an earlier run's stamps and another date.
_EARLIER = ('<ref uk:origin="OWN">a <ref>b</ref></ref><ref uk:origin="other">c</ref><FRBRdate date="1" name="enriched"/><FRBRdate date="2" name="made"/><uk:enrichment-engine>0</uk:enrichment-engine>', 'a b<ref uk:origin="other">c</ref><FRBRdate date="2" name="made"/>')


@query(P + f" select id as uri, concat(regexp_replace(markup, '</?ref[^>]*>', '', 'g'), '{_EARLIER[1]}') as xml from t")
def sanitised_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = corpus.paragraphs(spark, sf_dir)
    return replacing.sanitised(p.select(F.concat_ws("#", "uri", F.col("para_no").cast("string")).alias("uri"), F.concat("markup", F.lit(_EARLIER[0])).alias("xml")))


_JUDGMENT = """<akomaNtoso xmlns:uk="urn:statuta:akn"><judgment><meta><identification><FRBRManifestation><FRBRdate date="2020-01-01" name="made"/></FRBRManifestation></identification><proprietary></proprietary></meta><header/><judgmentBody><content>"""


def _judgments(spark: SparkSession, sf_dir: str, some: DataFrame | None = None) -> DataFrame:
    """Documents (uri, xml), or some (uri) of them."""
    p = corpus.paragraphs(spark, sf_dir, some).withColumn("markup", F.regexp_replace("markup", "</?ref[^>]*>", ""))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("para_no", "markup"))), lambda x: x["markup"]), "")
    return p.groupBy("uri").agg(F.concat(F.lit(_JUDGMENT), body, F.lit("</content></judgmentBody></judgment></akomaNtoso>")).alias("xml"))


@query(P + """, c as (select uri, regexp_replace(string_agg(regexp_replace(markup, '<[^>]+>', '', 'g'), '' order by para_no), '\\s+$', '') as text from p group by uri) select uri, text from c""")
def body_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``content`` only: the names of the other parts hold none of the three words
    d = _judgments(spark, sf_dir)
    return replacing.body_rows(d)


_REF = "concat('<ref href=\"http://statutes.example/', {year}, '/{n}{more}\" uk:canonical=\"', {year}, ' c. {n}{canonical}\" uk:type=\"legislation\" uk:origin=\"OWN\">', {text}, '</ref>')"
#: "the Act" means the paragraph's before; "the 1995 Act" the first of that year so far; sections the statute close by.
_RESOLVED = {
    "section0": _REF.format(year="act_year", n=1, more="/section/', sec, '/', line, '", canonical=" s. ', sec, '", text="concat('section ', sec, '(', line, ')')"),
    "section1": _REF.format(year="last_year", n=1, more="/section/', sec, '", canonical=" s. ', sec, '", text="concat('section ', sec)"),
    "section3": _REF.format(year="act_year", n=2, more="/section/', sec, '", canonical=" s. ', sec, '", text="concat('section ', sec)"),
    "the_act": _REF.format(year="last_year", n=1, more="", canonical="", text="'the Act'"),
    "numbered": "case when n is null then concat('the ', act_year, ' Act') else " + _REF.format(year="act_year", n="', n, '", more="", canonical="", text="concat('the ', act_year, ' Act')") + " end",
}


@query(
    P
    + ", a as (select uri, para_no + 1 as para_no, act_year as last_year from p where kind = 0), m as (select uri, para_no as m_para, act_year as m_year, case when kind = 0 then '1' else '2' end as n from p where kind <> 1)"
    + ", f as (select p.uri, para_no, n from p join m on m.uri = p.uri and m_year = act_year and m_para <= para_no where kind = 1 qualify row_number() over (partition by p.uri, para_no order by m_para) = 1)"
    + ", x as (select p.uri, p.para_no, "
    + _SPLICED.format(**_TAGS, **_RESOLVED)
    + " as markup from p left join a on a.uri = p.uri and a.para_no = p.para_no left join f on f.uri = p.uri and f.para_no = p.para_no)"
    + f" select uri, concat('{_JUDGMENT.replace('</proprietary>', '<uk:enrichment-engine xmlns:uk="urn:statuta:akn">1.0.0</uk:enrichment-engine></proprietary>')}', string_agg(markup, '' order by para_no), '</content></judgmentBody></judgment></akomaNtoso>') as xml, cast(null as varchar) as error from x group by uri"
)
def enrich_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole plan; the stamp's time is taken off so that runs compare."""
    out = enrich.enrich(_judgments(spark, sf_dir), manifest(spark), _lookup(spark, sf_dir))
    return out.select("uri", F.regexp_replace("xml", r'<FRBRdate date="[^"]*" name="enriched"/>', "").alias("xml"), "error")


# -- graph -------------------------------------------------------------------------------------------------


@query(
    P
    + """ select dst, count(*) as cited_by from (select distinct uri, concat('http://statutes.example/', act_year, '/1') as dst from p where kind = 0
 union select distinct uri, concat('http://cases.example/uksc/', case_year, '/', part) from p where kind = 0
 union select distinct uri, concat('http://cases.example/ewhc/ch/', case_year, '/', part) from p where kind = 1) group by dst"""
)
def citation_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stored(corpus.paragraphs(spark, sf_dir), "paragraphs")
    cases = caselaw.citations(p.select("uri", F.regexp_replace("markup", "<[^>]+>", "").alias("text")), manifest(spark))
    return graph.in_degree(graph.edges((cases, "case_uri"), (oblique.mentions(p), "href")))


@query(P + " select distinct concat('http://statutes.example/', act_year, '/1/section/', sec) as dst, concat('http://statutes.example/', act_year, '/1') as parent from p where kind = 0")
def section_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    defs = provisions.definitions(provisions.paired(corpus.paragraphs(spark, sf_dir)))
    return graph.parents(defs.select(F.col("section_href").alias("dst")))


_CITES = """select distinct uri as s, 'cites' as p, concat('http://statutes.example/', act_year, '/1/section/', sec) as o from p where kind = 0
 union select uri, 'cites', concat('http://cases.example/uksc/', case_year, '/', part) from p where kind = 0
 union select uri, 'cites', concat('http://cases.example/ewhc/ch/', case_year, '/', part) from p where kind = 1
 union select concat('http://statutes.example/', act_year, '/1/section/', sec), 'partOf', concat('http://statutes.example/', act_year, '/1') from p where kind = 0
 union select concat('http://statutes.example/', act_year, '/1'), 'partOf', concat('http://statutes.example/', act_year) from p where kind = 0"""


@query(
    P
    + f""", b as ({_CITES}), part as (select s, o from b where p = 'partOf'), up as (select s, o from part union select x.s, y.o from part x join part y on y.s = x.o),
 m as (select s, o from b where p = 'cites' union select b.s, up.o from b join up on up.s = b.o where b.p = 'cites')
 select s, p, o from b where p = 'cites' union all select s, 'partOf', o from up union all select o, 'citedIn', s from b where p = 'cites'
 union all select s, 'mentions', o from m union all select o, 'mentionedIn', s from m"""
)
def rule_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations, sections and volumes of statutes, and what follows from them by the rules."""
    p = stored(corpus.paragraphs(spark, sf_dir), "paragraphs")
    cases = caselaw.citations(p.select("uri", F.regexp_replace("markup", "<[^>]+>", "").alias("text")), manifest(spark))
    pairs = provisions.paired(p)
    sections = stored(provisions.definitions(pairs).select("uri", "section_href", "href"), "sections")
    cites = graph.edges((cases, "case_uri"), (sections, "section_href")).select(F.col("src").alias("s"), F.lit("cites").alias("p"), F.col("dst").alias("o"))
    part_of = graph.parents(sections.select(F.col("section_href").alias("dst")))
    volumes = sections.select(F.col("href").alias("dst"), F.regexp_replace("href", r"/[^/]*$", "").alias("parent"))
    return graph.entailed(cites.unionByName(part_of.unionByName(volumes).distinct().select(F.col("dst").alias("s"), F.lit("partOf").alias("p"), F.col("parent").alias("o"))))


_HIERARCHY = """select concat('r', r_regionkey) as s, 'hasDivision' as p, concat('n', n_nationkey) as o from region join nation on n_regionkey = r_regionkey
 union all select concat('n', n_nationkey), 'hasDivision', concat('s', s_suppkey) from nation join supplier on s_nationkey = n_nationkey"""


@query(f"with recursive h as ({_HIERARCHY}), r(top, node, depth) as (select s, o, 1 from h union all select r.top, h.o, r.depth + 1 from r join h on h.s = r.node) select top, node, min(depth) as depth from r group by top, node")
def court_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus.views(spark, sf_dir, "region", "nation", "supplier")
    return graph.closure(spark.sql(_HIERARCHY), "hasDivision")


# -- messages -------------------------------------------------------------------------------------------------


@query("select event_id, event_type as status, concat('d/', event_id) as uri_reference, user_id % 5 = 1 as callback from events where user_id % 7 <> 0 and event_type <> 'error'")
def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    message = F.to_json(F.struct(F.col("event_type").alias("status"), F.concat(F.lit("d/"), F.col("event_id").cast("string")).alias("uri_reference")))
    bucket = F.when(F.col("user_id") % 5 == 1, F.struct(F.struct(F.lit("back").alias("name")).alias("bucket")))
    body = F.to_json(F.struct(message.alias("Message"), F.when(F.col("user_id") % 7 == 0, F.lit("s3:TestEvent")).alias("Event"), bucket.alias("s3")))
    records = e.select("event_id", body.alias("body"), F.when(F.col("event_type") != "error", F.create_map(F.lit("trigger_enrichment"), F.lit("1"))).otherwise(F.create_map(F.lit("other"), F.lit("1"))).alias("attributes"))
    return messages.routed(messages.decoded(messages.subscribed(messages.without_tests(records))), "back").select("event_id", "status", "uri_reference", "callback")


@query("select user_id, max(ts) as last_asked, count(*) as messages from events group by user_id")
def last_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each document was last asked for."""
    return messages.last_asked(table(spark, sf_dir, "events").select(F.col("user_id").alias("uri_reference"), "ts")).select(F.col("uri_reference").alias("user_id"), "last_asked", "messages")


@query(
    f"""with e as ({ORACLE_SQL["enrich_judgments"]}), u as (select distinct cast(user_id as varchar) as uri, user_id % 10 as k from events where user_id % 7 <> 0)
 select u.uri, case when k not in (3, 4) then e.xml end as xml, case when k = 3 or e.uri is null then 'no document' when k = 4 then 'no proprietary element' end as error, cast(case when k in (3, 4) or e.uri is null then 4 else 0 end as int) as attempts
 from u left join e on e.uri = u.uri"""
)
def stream_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of messages: the documents they ask for, enriched by the whole plan, or the reason why not, after four attempts."""
    source = f"{sf_dir}/events.parquet"
    # a pattern, since a stream's source is a folder or a pattern
    e = spark.readStream.schema(spark.read.parquet(source).schema).parquet(f"{sf_dir}/events.parque[t]")
    message = F.to_json(F.struct(F.lit("published").alias("status"), F.col("user_id").cast("string").alias("uri_reference")))
    body = F.to_json(F.struct(message.alias("Message"), F.when(F.col("user_id") % 7 == 0, F.lit("s3:TestEvent")).alias("Event")))
    sent = e.select(F.col("event_id").cast("string").alias("message_id"), F.col("ts").cast("timestamp").alias("ts"), body.alias("body"))
    users = table(spark, sf_dir, "events").where("user_id % 10 <> 3").select(F.col("user_id").cast("string").alias("uri")).distinct()
    kept = F.when(F.col("uri").cast("long") % 10 == 4, F.replace("xml", F.lit("<proprietary></proprietary>"), F.lit(""))).otherwise(F.col("xml"))
    judgments = stored(_judgments(spark, sf_dir, users).select("uri", kept.alias("xml")), "judgments")
    rules_, known = manifest(spark), stored(_lookup(spark, sf_dir), "lookup")
    titles = enrich.matcher(judgments, known)
    out = _folder(spark, "stream")
    attempts.drain(lambda: attempts.enrich_stream(sent, judgments, lambda docs: enrich.enrich(docs, rules_, known, titles=titles), f"{out}/table", f"{out}/checkpoint"))
    done = documents.read(spark, f"{out}/table/documents").select("uri", F.regexp_replace("xml", r'<FRBRdate date="[^"]*" name="enriched"/>', "").alias("xml"), F.lit(None).cast("string").alias("error"), F.lit(0).alias("attempts"))
    return done.unionByName(attempts.dead_letters(spark, f"{out}/table").select("uri", F.lit(None).cast("string").alias("xml"), "error", "attempts"))


@query("select event_id, concat('d/', user_id) as uri, case when user_id % 3 = 0 then concat('<d a=\"1\" b=\"', user_id, '\"></d>') end as xml from events")
def message_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object events with the document each names, canonical."""
    e = table(spark, sf_dir, "events")
    key = F.concat(F.lit("d%2F"), F.col("user_id").cast("string"), F.lit(".xml"))
    body = F.to_json(F.struct(F.struct(F.struct(F.lit("in").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3")))
    users = e.select("user_id").distinct().where("user_id % 3 = 0")
    docs = users.select(F.concat(F.lit("d/"), F.col("user_id").cast("string")).alias("uri"), F.concat(F.lit("<d b='"), F.col("user_id").cast("string"), F.lit("' a='1'/>")).alias("xml"))
    return messages.objects(e.select("event_id", body.alias("body")), docs).select("event_id", "uri", "xml")


# -- sources and sinks ------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/statuta/{name}-{uuid.uuid4().hex}"


def _put(spark: SparkSession, path: str, lines: DataFrame, column: str) -> None:
    """Files of given names (name, and a column with the text), for sources that read names; a small table."""
    for r in lines.collect():
        files, p = log.files(spark, f"{path}/{r['name']}")
        out = files.create(p, True)
        out.write(bytearray(r[column].encode()))
        out.close()


@query("select concat('court/2024/', n_nationkey) as uri, concat('<j>', n_name, ' é</j>') as xml from nation")
def judgment_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, n = _folder(spark, "judgments"), F.col("n_nationkey").cast("string")
    docs = table(spark, sf_dir, "nation").select(F.concat(F.lit("court%2F2024%2F"), n, F.lit(".xml")).alias("name"), F.concat(F.lit("<j>"), "n_name", F.lit(" é</j>")).alias("xml"))
    _put(spark, path, docs.unionByName(docs.limit(1).withColumn("name", F.lit("notes.txt"))), "xml")
    return readers.judgments(spark, path)


@query("select concat('u', n_nationkey) as uri, 'abb' as kind, n_name as short, 'a \"long\" form' as long from nation")
def replacement_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, n = _folder(spark, "replacements"), F.col("n_nationkey").cast("string")
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit("u"), n).alias("uri"), F.lit("abb").alias("kind"), F.array("n_name", F.lit('a "long" form')).alias("fields"))
    _put(spark, path, replacing.encoded(rows).select(F.concat("uri", F.lit("_replacements.txt")).alias("name"), "value"), "value")
    return replacing.decoded(readers.replacements(spark, path)).select("uri", "kind", F.get("fields", F.lit(0)).alias("short"), F.get("fields", F.lit(1)).alias("long"))


@query(f"select id, uri_template, canonical_form, is_canonical, is_neutral, pattern from ({_COURTS})")
def manifest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns full of quotes, doubled in the files; files of another kind beside them."""
    path, m = _folder(spark, "manifest"), _courts(spark, sf_dir)
    m.write.option("header", True).option("escape", '"').csv(path)
    m.select("id").write.mode("append").text(path)
    return readers.manifest(spark, path).select("id", "uri_template", "canonical_form", "is_canonical", "is_neutral", "pattern")


_TOKENS = "[{'a': 'ORTH', 'v': '['}, {'a': 'SHAPE', 'v': 'dddd'}, {'a': 'ORTH', 'v': ']'}, {'a': 'ORTH', 'v': regexp_extract(canonical_form, ' (.*) ', 1)}, {'a': 'LIKE_NUM', 'v': 'true'}]"
_GOOD = f"(select * from ({_COURTS}) where cast(substr(id, 7) as int) % 5 <> 3 and cast(substr(id, 7) as int) % 7 <> 6)"


@query(f"select id, cast(k - 1 as int) as place, t[k].a as attribute, t[k].v as value, family from (select id, family, {_TOKENS} as t from {_GOOD}), unnest(generate_series(1, 5)) g(k)")
def published_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules are published and the manifest's table replaced, twice; rules that fail are not. Patterns are read back as JSON, families from the table."""
    path, m = _folder(spark, "patterns"), _courts(spark, sf_dir)
    n = F.substring("id", 7, 2).cast("int")
    good, name = m.where((n % 5 != 3) & (n % 7 != 6)), f"manifest_{uuid.uuid4().hex}"
    outcome = [writers.rules(x, path, name) for x in (good.where(n < 3), m, good, m)]
    if outcome != [True, False, True, False]:
        raise RuntimeError(f"published: {outcome}")
    tokens = readers.patterns(spark, f"{path}/{log.entries(spark, path)[-1]['data']}").select("id", F.posexplode("pattern").alias("place", "t"))
    return tokens.join(spark.table(name).select("id", "family"), "id").select("id", F.col("place").cast("int").alias("place"), F.explode("t").alias("attribute", "value"), "family")


@query(
    """with x as (select concat('v/', n_nationkey) as uri, concat('<j a="1">', n_name, '</j>') as xml from nation) select * from x"""
)
def external_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents handed to another system as JSON lines."""
    path = _folder(spark, "external")
    docs = table(spark, sf_dir, "nation").select(F.concat(F.lit("v/"), F.col("n_nationkey").cast("string")).alias("uri"), F.concat(F.lit('<j a="1">'), "n_name", F.lit("</j>")).alias("xml"))
    writers.external_copy(docs, path)
    return spark.read.schema("uri string, xml string").json(path)


@query("select concat('c/', c_custkey) as uri, concat('<d>', case when c_custkey % 3 = 0 then 'second ' when c_custkey % 5 = 2 then 'third ' else 'first ' end, c_name, '</d>') as xml from customer where c_custkey % 5 <> 1 or c_custkey % 3 = 0")
def documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents added in batches, one of them twice, with a uri twice in a batch, and a compaction between them."""
    path, c = _folder(spark, "documents"), table(spark, sf_dir, "customer")
    version = lambda rows, word: rows.select(F.concat(F.lit("c/"), F.col("c_custkey").cast("string")).alias("uri"), F.concat(F.lit(f"<d>{word} "), "c_name", F.lit("</d>")).alias("xml"))
    first, third, second = c.where("c_custkey % 5 <> 1"), c.where("c_custkey % 5 = 2"), c.where("c_custkey % 3 = 0")
    documents.append(version(first, "earlier").unionByName(version(first, "first")), path, "1")
    documents.append(version(third, "third"), path, "2")
    documents.compact(spark, path)
    documents.append(version(first, "again"), path, "1")
    documents.append(version(second, "second"), path, "3")
    documents.append(version(second, "again"), path, "3")
    return documents.read(spark, path)


_XSD = """<?xml version="1.0"?><xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="d"><xs:complexType><xs:sequence>
<xs:element name="n" type="xs:integer"/><xs:element name="name" type="xs:string"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""


@query("select case when n_nationkey % 5 = 0 then -1 else cast(n_nationkey as bigint) end as n, n_nationkey % 5 <> 0 as valid, count(*) as documents from nation group by 1, 2")
def xsd_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against an XSD; every fifth has a word for its number."""
    path = _folder(spark, "validated")
    number = F.when(F.col("n_nationkey") % 5 == 0, F.lit("five")).otherwise(F.col("n_nationkey").cast("string"))
    docs = table(spark, sf_dir, "nation").select(F.concat(F.lit("<d><n>"), number, F.lit("</n><name>"), "n_name", F.lit("</name></d>")).alias("xml"))
    _put(spark, path, spark.createDataFrame([("documents.xsd", _XSD)], "name string, xsd string"), "xsd")
    read = readers.validated(docs, "n long, name string", f"{path}/documents.xsd").select("parsed.*")
    return read.groupBy(F.when(F.col("invalid").isNull(), F.col("n")).otherwise(-1).alias("n"), F.col("invalid").isNull().alias("valid")).agg(F.count("*").alias("documents"))


# -- scalars over whole tables --------------------------------------------------------------------------------------

_TYPES = [
    ("NCitYearAbbrNum", "[dddd] UKSC d+", "concat('(', y, ') UKSC ', a)", "concat('[', y, '] UKSC ', a)"),
    ("NCitYearAbbrNumDiv", "[dddd] EWHC d+ (Ch)", "concat('(', y, ') EWHC ', a, ' Ch')", "concat('[', y, '] EWHC ', a, ' (Ch)')"),
    ("PubYearAbbrNum", "[dddd] PNLR d+", "concat('[', y, '] P.N.L.R ', a)", "concat('[', y, '] PNLR ', a)"),
    ("NCitYearAbbrNumUnderNumDiv", "[dddd] XTU d1_d2 (A)", "concat('(', y, ') XTU ', a, '_', b, ' (A)')", "concat('[', y, '] XTU ', a, '_', b, ' (A)')"),
    ("NCitYearAbrrNumStrokeNum", "[dddd] XTS d1/d2", "concat('(', y, ') XTS ', a, '/', b)", "concat('[', y, '] XTS ', a, '/', b)"),
    ("PubYearNumAbbrNum", "[dddd] d1 WLR d2", "concat('(', y, ') ', a, ' W.L.R. ', b)", "concat('[', y, '] ', a, ' WLR ', b)"),
    ("PubAbbrNumAbbrNum", "AB d1 CD d2", "concat('A.B. ', a, ' C.D. ', b)", "concat('AB ', a, ' CD ', b)"),
    ("PubNumAbbrNum", "d1 ExD d2", "concat(a, ' Ex.D. ', b)", "concat(a, ' ExD ', b)"),
    ("EUCCase", "Case C-d1/d2", "concat('C-', a, '/', b)", "concat('Case C-', a, '/', b)"),
    ("EUTCase", "Case T-d1/d2", "concat('T-', a, '/', b)", "concat('Case T-', a, '/', b)"),
    ("Unknown", "[dddd] d+", "concat('x', a)", "cast(null as varchar)"),
]
_PARTS = "select l_orderkey, l_linenumber, l_partkey, cast(year(l_shipdate) as string) as y, cast(l_suppkey as string) as a, cast(l_partkey as string) as b, (l_partkey + l_linenumber) % 11 as k from lineitem"


def _by_kind(values: list[str]) -> str:
    return "case k " + " ".join(f"when {k} then {v}" for k, v in enumerate(values)) + " end"


@query(f"select l_orderkey, l_linenumber, l_partkey, {_by_kind([repr(t[0]) for t in _TYPES])} as kind, {_by_kind([t[3] for t in _TYPES])} as corrected_citation from ({_PARTS}) x")
def citation_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten types, and an unknown one."""
    corpus.views(spark, sf_dir)
    d = spark.sql(f"select *, {_by_kind([repr(t[0]) for t in _TYPES])} as kind, {_by_kind([t[2] for t in _TYPES])} as m, {_by_kind([repr(t[1]) for t in _TYPES])} as form from ({_PARTS}) x")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "kind", S.corrected_citation(F.col("kind"), F.col("m"), F.col("form")).alias("corrected_citation"))


@query(
    """select o_orderkey, concat('ewhc/ch/', o_orderkey, '.xml.d') as document_key, concat('a &lt;b&gt; &amp; &quot;', o_orderpriority, '&quot; &#x27;c&#x27;') as escaped,
 case when o_orderkey % 2 = 0 then '<?xml version="1.0"?>' else '' end as declaration, concat('<d>', o_orderpriority, '</d>') as rest, o_orderpriority as title, '1998' as title_year from orders"""
)
def document_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, escapes, declarations and titles of documents."""
    o = table(spark, sf_dir, "orders")
    n, p = F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
    xml = F.concat(F.when(F.col("o_orderkey") % 2 == 0, F.lit('<?xml version="1.0"?>')).otherwise(F.lit("")), F.lit("<d>"), p, F.lit("</d>"))
    declaration, rest = S.xml_declaration(xml)
    title, year = S.split_title_year(F.concat(p, F.lit("1998")))
    escaped = S.html_escape(F.concat(F.lit('a <b> & "'), p, F.lit("\" 'c'")))
    return o.select("o_orderkey", S.document_key(F.concat(F.lit("ewhc%2Fch%2F"), n, F.lit(".xml.d.xml"))).alias("document_key"), escaped.alias("escaped"), declaration.alias("declaration"), rest.alias("rest"), title.alias("title"), year.alias("title_year"))


@query("select s_suppkey, concat('<s a=\"', s_suppkey, '\" b=\"1\"><n>', s_name, '</n></s>') as xml, true as same from supplier")
def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical forms, and whether two spellings of a document are equal."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    docs = s.select("s_suppkey", F.concat(F.lit("<?xml version='1.0'?><s b='1' a='"), k, F.lit("'><n>"), "s_name", F.lit("</n></s>")).alias("one"), F.concat(F.lit('<s  a="'), k, F.lit('" b="1" >\n <n>'), "s_name", F.lit("</n>\n</s>")).alias("two"))

    def of(row: dict):
        from statuta.functions.markup import canonical, equal_xml

        yield {"s_suppkey": row["s_suppkey"], "xml": canonical(row["one"]), "same": equal_xml(row["one"], row["two"])}

    return map_rows(docs, f"s_suppkey {docs.schema['s_suppkey'].dataType.simpleString()}, xml string, same boolean", of)
