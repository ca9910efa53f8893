"""Entity resolution on documents (offers) and embeddings (their vectors)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.functions.rates import harmonic, pair_measures, rate
from tallyloom.operators import bandcount as bc
from tallyloom.operators import linkage as lk
from tallyloom.operators.ordered import running
from tallyloom.plans.panel_queries import r
from tallyloom.plans.registry import query
from tallyloom.plans.standins import table
from tallyloom.session import stage

# Vector length of the table, planes written into the SQL, bands of the pair queries.
LENGTH = 64
BANDS = 4
SQL_PLANES = 40
SEED = 1


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as offers: shop = source, title = the whole text, brand in the features."""
    features = (
        F.when(F.col("lang") == "en", F.create_map(F.lit("Brand"), F.col("source")))
        .when(F.col("lang") == "fr", F.create_map(F.lit("Brand Name"), F.col("source")))
        .otherwise(F.expr("map()").cast("map<string,string>"))
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("shop"), F.col("lang").alias("brand"),
        F.col("text").alias("title"), features.alias("features"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their true model; shop, brand and text where a document has their id.

    ``content`` is equal where vector and text are.
    """
    shops = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("shop"), F.col("lang").alias("brand"), F.md5("text").alias("text"))
    joined = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("model")
    ).join(shops, "id", "left")
    parts = F.concat_ws(",", F.transform("vector", lambda x: x.cast("string")), F.coalesce("text", F.lit("-")))
    return joined.select("id", "vector", "model", "shop", "brand", F.md5(parts).alias("content"))


def signed_vectors(spark, sf_dir, bands: int, seed: int = SEED) -> DataFrame:
    """(id, model, shop, brand, content, hashes)"""
    points = table(spark, sf_dir, "embeddings").count()  # from the file footers
    return lk.signatures(vectors(spark, sf_dir), "vector", bands, LENGTH, points, seed).drop("vector")


VECTORS_SQL = """
vectors as (
  select e.vec_id as id, e.embedding as vector, e.label as model, d.source as shop, d.lang as brand, d.text as content
  from embeddings e left join documents d on e.vec_id = d.doc_id)"""


def signature_sql(bands: int, seed: int = SEED, name: str = "sig") -> str:
    """(id, model, shop, brand, band, hash) in SQL, the planes as literals."""
    rows = LENGTH // bands
    matrix = lk.planes(rows, SQL_PLANES, seed).tolist()
    literals = ", ".join(f"({j}, {plane}::double[])" for j, plane in enumerate(matrix))
    return f"""
{name}_planes as (select * from (values {literals}) t(j, plane)
  where j < (select ceil(log2(8 * count(*))) from embeddings)),
{name}_bands as (
  select id, model, shop, brand, content, vector, b as band,
         list_transform(vector[b * {rows} + 1 : (b + 1) * {rows}], lambda x: cast(x as double)) as v
  from vectors, range({bands}) t(b)),
{name} as (
  select id, model, shop, brand, content, vector, cast(band as integer) as band,
         cast(sum(case when list_dot_product(v, plane) >= 0 then 1 << j else 0 end) as bigint) as hash
  from {name}_bands, {name}_planes group by id, model, shop, brand, content, vector, band)"""


def pairs_sql(source: str, same: str | None = None, different: str | None = None, alike: str = "model", name: str = "linked") -> str:
    """Pairs of classes of ``source`` (id, band, hash, ...), the records they stand for counted."""
    own = ", ".join(dict.fromkeys([*([same] if same else []), *([different] if different else []), *alike.split(", ")]))
    rule = (f" and a.{same} = b.{same}" if same else "") + (f" and a.{different} <> b.{different}" if different else "")
    inside = "" if different else f"""
  union all select id, id, cast(copies * (copies - 1) / 2 as bigint) from {name}_classes where copies > 1
    {f"and {same} is not null" if same else ""}"""
    return f"""
{name}_records as (select id, {own}, list(band || ':' || hash order by band) as tags from {source} group by id, {own}),
{name}_classes as (select min(id) as id, count(*) as copies, tags, {own} from {name}_records group by tags, {own}),
{name} as (
  select a.id as id_a, b.id as id_b, a.copies * b.copies as pairs from {name}_classes a join {name}_classes b
    on a.id < b.id and list_has_any(a.tags, b.tags){rule}{inside})"""


@query("offer_brand", "B14 U1", r"""
select doc_id as id, case lang when 'en' then source when 'fr' then source
       else nullif(regexp_extract(text, '\S+', 0), '') end as brand from documents""")
def offer_brand(spark, sf_dir):
    o = offers(spark, sf_dir)
    return o.select("id", tx.brand_of(F.col("features"), F.col("title")).alias("brand"))


def _without(text: str, marks: list[str]) -> str:
    for mark in marks:
        text = f"replace({text}, '{mark}', '')"
    return text


_LONGEST = "m[list_position(list_transform(m, lambda x: length(x)), list_max(list_transform(m, lambda x: length(x))))]"
MODEL_ID_SQL = f"""
found as (select doc_id as id, text, regexp_extract_all(text, '{tx.MODEL_ID_PATTERN}', 0) as m from documents),
ids as (select id, text, case when len(m) > 0 then {_without(_LONGEST, tx.MODEL_ID_NOISE)} end as model_id from found)
"""


@query("offer_model_id", "B15 U5", f"with {MODEL_ID_SQL} select id, model_id from ids")
def offer_model_id(spark, sf_dir):
    return offers(spark, sf_dir).select("id", tx.model_id(F.col("title")).alias("model_id"))


@query("offer_projection", "B16 U1", """
select doc_id as id, md5(text || case when lang in ('en', 'fr') then ' ' || source else '' end) as joined,
       case when lang = 'en' then source end as brand_feature,
       1 + case when lang in ('en', 'fr') then 1 else 0 end as parts
from documents""")
def offer_projection(spark, sf_dir):
    o = offers(spark, sf_dir)
    parts = tx.projected([F.col("title")], F.col("features"))
    only = tx.projected([], F.col("features"), ["Brand"])
    return o.select(
        "id", F.md5(tx.blocking_text(["everything"], F.col("title"), F.col("features"))).alias("joined"),
        F.try_element_at(only, F.lit(1)).alias("brand_feature"), F.size(parts).alias("parts"))


@query("blocking_text", "U1 U5", f"""
with {MODEL_ID_SQL}
select i.id, md5(concat_ws(' ', d.source_or_word, i.model_id)) as blocking from ids i join (
  select doc_id, case lang when 'en' then source when 'fr' then source
         else nullif(regexp_extract(text, '\\S+', 0), '') end as source_or_word from documents) d
  on i.id = d.doc_id""")
def blocking_text(spark, sf_dir):
    chosen = tx.blocking_text(["brand", "model_id"], F.col("title"), F.col("features"))
    return offers(spark, sf_dir).select("id", F.md5(chosen).alias("blocking"))


@query("row_positions", "E20", """
select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as position from orders""")
def row_positions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return running(orders, "o_totalprice", ["o_orderkey"], descending=True, staged=False).drop("o_totalprice")


@query("true_pairs", "C9 I1", """
select vec_id as id, label as model, count(*) over (partition by label) as size,
       cast(count(*) over (partition by label) * (count(*) over (partition by label) - 1) / 2 as bigint) as pairs
from embeddings qualify count(*) over (partition by label) > 1""")
def true_pairs(spark, sf_dir):
    return lk.truth_groups(vectors(spark, sf_dir), "model")


@query("model_id_pairs", "C9 I1", f"""
with {MODEL_ID_SQL}
select id, model_id, count(*) over (partition by model_id) as size,
       cast(count(*) over (partition by model_id) * (count(*) over (partition by model_id) - 1) / 2 as bigint) as pairs
from ids where model_id is not null qualify count(*) over (partition by model_id) > 1""")
def model_id_pairs(spark, sf_dir):
    named = offers(spark, sf_dir).select("id", tx.model_id(F.col("title")).alias("model_id"))
    return lk.truth_groups(named, "model_id")


@query("band_signatures", "B18 I3", f"""
with {VECTORS_SQL}, {signature_sql(8)}
select id, band, hash from sig""")
def band_signatures(spark, sf_dir):
    return lk.bucket_rows(signed_vectors(spark, sf_dir, 8), ["id"])


@query("bucket_sizes", "D11", f"""
with {VECTORS_SQL}, {signature_sql(8)}
select band, hash, count(*) as size, min(id) as first_id from sig group by band, hash having count(*) >= 2""")
def bucket_sizes(spark, sf_dir):
    rows = lk.bucket_rows(signed_vectors(spark, sf_dir, 8), ["id"])
    return lk.bucket_sizes(rows, ["band", "hash"])


@query("distinct_buckets", "G4", f"""
with {VECTORS_SQL}, {signature_sql(16)},
sets as (select distinct list_sort(list(id)) as members from sig group by band, hash having count(*) >= 2)
select len(members) as size, members[1] as first_id from sets""")
def distinct_buckets(spark, sf_dir):
    rows = lk.bucket_rows(signed_vectors(spark, sf_dir, 16), ["id"])
    return lk.distinct_bucket_contents(rows).select("size", "first_id")


@query("bucket_members", "C10 D11", f"""
with {VECTORS_SQL}, {signature_sql(8)},
big as (select band, hash, count(*) as size from sig group by band, hash having count(*) >= 2)
select s.id, s.band, s.hash, b.size, round(list_sum(list_transform(v.vector, lambda x: cast(x as double))), 4) as total
from sig s join big b on s.band = b.band and s.hash = b.hash join vectors v on v.id = s.id""")
def bucket_members(spark, sf_dir):
    rows = lk.bucket_rows(signed_vectors(spark, sf_dir, 8), ["id"])
    members = rows.join(lk.bucket_sizes(rows, ["band", "hash"]).drop("first_id"), ["band", "hash"])
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return members.join(vectors(spark, sf_dir).select("id", r(total, 4).alias("total")), "id").select(
        "id", "band", "hash", "size", "total")


@query("candidate_pairs", "I4", f"""
with {VECTORS_SQL}, {signature_sql(BANDS)}, {pairs_sql("sig")}
select id_a, id_b, pairs from linked""")
def candidate_pairs(spark, sf_dir):
    return lk.candidate_pairs(signed_vectors(spark, sf_dir, BANDS), alike=["model"])


@query("blocked_pairs", "C12 I6", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig", "brand", "shop")}
select id_a, id_b, pairs, a.brand from linked join vectors a on a.id = id_a""")
def blocked_pairs(spark, sf_dir):
    return lk.candidate_pairs(signed_vectors(spark, sf_dir, 8), same=["brand"], different="shop", alike=["model"])


@query("labelled_pairs", "C11 I7", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig")}
select l.id_a, l.id_b, l.pairs, cast(a.model = b.model as integer) as label
from linked l join vectors a on a.id = l.id_a join vectors b on b.id = l.id_b""")
def labelled_pairs(spark, sf_dir):
    signed = signed_vectors(spark, sf_dir, 8)
    return lk.label_pairs(lk.candidate_pairs(signed, alike=["model"]), vectors(spark, sf_dir), "model")


@query("false_candidates", "C11 G5 I7", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig")}
select l.id_a, l.id_b, l.pairs, 0 as label
from linked l join vectors a on a.id = l.id_a join vectors b on b.id = l.id_b where a.model <> b.model""")
def false_candidates(spark, sf_dir):
    signed = signed_vectors(spark, sf_dir, 8)
    return lk.label_pairs(lk.candidate_pairs(signed, alike=["model"]), vectors(spark, sf_dir), "model", keep=0)


def members_sql(own: str) -> str:
    """Membership of the classes of ``pairs_sql`` with the same columns ``own``."""
    return f"""
select id, min(id) over (partition by tags, {own}) as representative, count(*) over (partition by tags, {own}) as copies
from linked_records"""


@query("candidate_members", "I4", f"""
with {VECTORS_SQL}, {signature_sql(BANDS)}, {pairs_sql("sig")} {members_sql("model")}""")
def candidate_members(spark, sf_dir):
    """Who belongs to the classes of candidate_pairs."""
    return lk.class_members(signed_vectors(spark, sf_dir, BANDS), alike=["model"])


@query("labelled_members", "C11 I7", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig")} {members_sql("model")}""")
def labelled_members(spark, sf_dir):
    """Who belongs to the classes of labelled_pairs, false_candidates and balanced_pairs."""
    return lk.class_members(signed_vectors(spark, sf_dir, 8), alike=["model"])


@query("blocked_members", "C12 I6", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig", "brand", "shop")} {members_sql("brand, shop, model")}""")
def blocked_members(spark, sf_dir):
    """Who belongs to the classes of blocked_pairs."""
    return lk.class_members(signed_vectors(spark, sf_dir, 8), alike=["brand", "shop", "model"])


@query("feature_members", "I10", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig", "brand", "shop", "vector, content")}
{members_sql("brand, shop, vector, content")}""")
def feature_members(spark, sf_dir):
    """Who belongs to the classes of pair_features."""
    return lk.class_members(signed_vectors(spark, sf_dir, 8), alike=["brand", "shop", "content"])


def _order_hash(a: str, b: str):
    """Eight hex digits of an md5 as a number: the same in Spark and SQL."""
    joined = F.concat_ws("-", F.col(a).cast("string"), F.col(b).cast("string"))
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("double")


@query("balanced_pairs", "I8", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig")},
labelled as (
  select l.id_a, l.id_b, cast(a.model = b.model as integer) as label,
         cast('0x' || substr(md5(l.id_a || '-' || l.id_b), 1, 8) as bigint) as h
  from linked l join vectors a on a.id = l.id_a join vectors b on b.id = l.id_b),
sizes as (select count(*) filter (label = 1) as p, count(*) filter (label = 0) as n from labelled),
ranked as (select *, row_number() over (partition by label order by h, id_a, id_b) as rn from labelled),
timed as (
  select r.*, case when (label = 1 and p <= n) or (label = 0 and n < p)
         then greatest(p, n) // least(p, n) + case when rn <= greatest(p, n) % least(p, n) then 1 else 0 end
         else 1 end as times from ranked r, sizes)
select id_a, id_b, label, cast(unnest(range(1, cast(times as bigint) + 1)) as integer) as copy from timed""")
def balanced_pairs(spark, sf_dir):
    signed = signed_vectors(spark, sf_dir, 8)
    labelled = lk.label_pairs(lk.candidate_pairs(signed, alike=["model"]), vectors(spark, sf_dir), "model").drop("pairs")
    return lk.balance(labelled, _order_hash("id_a", "id_b"), ["id_a", "id_b"])


@query("balanced_pair_weights", "I8", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig")},
labelled as (
  select l.id_a, l.id_b, l.pairs, cast(a.model = b.model as integer) as label
  from linked l join vectors a on a.id = l.id_a join vectors b on b.id = l.id_b),
sizes as (select sum(pairs) filter (label = 1) as p, sum(pairs) filter (label = 0) as n from labelled)
select id_a, id_b, cast(pairs as bigint) as pairs, label,
       round(coalesce(pairs * cast(greatest(p, n) as double) / case when p > 0 and n > 0 then if(label = 1, p, n) end, pairs), 6) as weight
from labelled, sizes""")
def balanced_pair_weights(spark, sf_dir):
    """Both labels with the same weight over record pairs; balanced_pairs balances the pairs of classes."""
    pairs = lk.candidate_pairs(signed_vectors(spark, sf_dir, 8), alike=["model"])
    weighed = lk.balance_weights(lk.label_pairs(pairs, vectors(spark, sf_dir), "model"))
    return weighed.select("id_a", "id_b", "pairs", "label", r("weight", 6).alias("weight"))


@query("bootstrap_split", "C8 G5 I9", """
with n as (select count(*) as n from documents),
indexed as (select doc_id, row_number() over (order by doc_id) as position from documents),
drawn as (select distinct cast('0x' || substr(md5('5-' || position), 1, 8) as bigint) % n as drawn from indexed, n)
select doc_id, case when d.drawn is not null then 'train' else 'test' end as split
from indexed i left join drawn d on i.position - 1 = d.drawn""")
def bootstrap_split(spark, sf_dir):
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("5-"), F.col("k").cast("string"))), 1, 8), 16, 10)
    ids = table(spark, sf_dir, "documents").select("doc_id")
    return lk.bootstrap_split(ids, "doc_id", draw.cast("long") % F.col("n"))


@query("minhash_values", "I5", r"""
with words as (
  select doc_id, list_filter(list_distinct(regexp_split_to_array(lower(text), '[ \n\r\t]+')), lambda w: w <> '') as w
  from documents),
idx as (select doc_id, list_transform(w, lambda x: cast('0x' || substr(md5(x), 1, 7) as bigint)) as i from words)
select doc_id, list_min(list_transform(i, lambda x: ((48271 * x + 11) % 2147483647) % 1000003)) as h1,
       list_min(list_transform(i, lambda x: ((69621 * x + 23) % 2147483647) % 1000003)) as h2,
       len(i) as words from idx""")
def minhash_values(spark, sf_dir):
    words = tx.tokens(F.col("text"))
    index = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("long"))
    indexed = table(spark, sf_dir, "documents").select("doc_id", index.alias("i"))
    # Prime, bins and the (a, b) of each hash.
    prime, bins = 2147483647, 1000003
    return indexed.select(
        "doc_id", lk.minhash(F.col("i"), 48271, 11, prime, bins).alias("h1"),
        lk.minhash(F.col("i"), 69621, 23, prime, bins).alias("h2"), F.size("i").cast("long").alias("words"))


def _pair_records(spark, sf_dir) -> DataFrame:
    # only the texts that a vector has are cut into words, so they are joined whole
    joined = vectors(spark, sf_dir).select("id", "vector").join(offers(spark, sf_dir).select("id", "title"), "id", "left")
    return joined.select(
        "id", "vector", tx.tokens(F.col("title")).alias("tokens"), tx.model_id(F.col("title")).alias("model_id"),
        F.length("title").alias("length"))


@query("pair_features", "I10", rf"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig", "brand", "shop", "vector, content")}, {MODEL_ID_SQL},
records as (
  select v.id, list_transform(v.vector, lambda x: cast(x as double)) as vector,
         list_filter(list_distinct(regexp_split_to_array(lower(i.text), '[ \n\r\t]+')), lambda w: w <> '') as tokens,
         i.model_id, length(i.text) as length
  from vectors v join ids i on v.id = i.id)
select l.id_a, l.id_b, round(list_cosine_similarity(a.vector, b.vector), 5) as cosine,
       round(len(list_intersect(a.tokens, b.tokens)) / (len(a.tokens) + len(b.tokens)
             - len(list_intersect(a.tokens, b.tokens))), 6) as overlap,
       coalesce(cast(a.model_id = b.model_id as double), 0) as same_model,
       round(abs(a.length - b.length) / greatest(a.length, b.length), 6) as length_gap
from linked l join records a on a.id = l.id_a join records b on b.id = l.id_b""")
def pair_features(spark, sf_dir):
    pairs = lk.candidate_pairs(
        signed_vectors(spark, sf_dir, 8), same=["brand"], different="shop", alike=["content"],
        carried=stage(_pair_records(spark, sf_dir), "records")).drop("brand")
    f = lk.pair_features(pairs)
    return f.select("id_a", "id_b", r("cosine", 5).alias("cosine"), r("overlap", 6).alias("overlap"),
                    "same_model", r("length_gap", 6).alias("length_gap"))


@query("pair_classifier_measures", "I10 I12")
def pair_classifier_measures(spark, sf_dir):
    signed = signed_vectors(spark, sf_dir, 8)
    records = vectors(spark, sf_dir)
    sides = stage(records.select("id", "model").join(_pair_records(spark, sf_dir), "id"), "records")
    labelled = lk.label_pairs(lk.candidate_pairs(signed, alike=["model", "content"], carried=sides, features=True), None, "model")
    features = stage(lk.pair_features(labelled).drop("id_a", "id_b"), "features")
    model = lk.fit_pair_classifier(features)
    scored = lk.duplicate_probability(model, features)
    truth = records.groupBy("model").count().agg(
        F.sum(F.col("count") * (F.col("count") - 1) / 2)).scalar()
    return pair_measures(scored, "label", "p", truth, weight=F.col("pairs"))


#: Cosine above which two vectors count as one model. The models of the table lie close together, so it is low;
#: all four counts are above zero there.
SAME_MODEL = 0.2


@query("pair_measures_by_cosine", "I12 G6", f"""
with {VECTORS_SQL}, {signature_sql(8)}, {pairs_sql("sig", alike="model, vector, content")},
scored as (
  select l.pairs as n, cast(a.model = b.model as integer) as label,
         list_cosine_similarity(list_transform(a.vector, lambda x: cast(x as double)),
                                list_transform(b.vector, lambda x: cast(x as double))) as p
  from linked l join vectors a on a.id = l.id_a join vectors b on b.id = l.id_b),
truth as (select sum(n * (n - 1) / 2) as duplicates from (select count(*) as n from vectors group by model)),
c as (select cast(coalesce(sum(n) filter (label = 1 and p > {SAME_MODEL}), 0) as double) as tp,
             cast(coalesce(sum(n) filter (label = 0 and p <= {SAME_MODEL}), 0) as double) as tn,
             cast(coalesce(sum(n) filter (label = 0 and p > {SAME_MODEL}), 0) as double) as fp,
             cast(coalesce(sum(n) filter (label = 1 and p <= {SAME_MODEL}), 0) as double) as fn,
             cast(coalesce(sum(n), 0) as double) as pairs, (select cast(duplicates as double) from truth) as duplicates from scored),
m as (select *, coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
        coalesce(tp / nullif(pairs, 0), 0) as pair_quality, coalesce(tp / nullif(duplicates, 0), 0) as pair_completeness
      from c),
f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) as f1,
        coalesce(2 * pair_quality * pair_completeness / nullif(pair_quality + pair_completeness, 0), 0) as f1_star from m)
select tp, tn, fp, fn, pairs, duplicates, round(precision, 8) as precision, round(recall, 8) as recall,
       round(pair_quality, 8) as pair_quality, round(pair_completeness, 8) as pair_completeness,
       round(f1, 8) as f1, round(f1_star, 8) as f1_star,
       round(coalesce(2 * f1 * f1_star / nullif(f1 + f1_star, 0), 0), 8) as f1_hat from f""")
def pair_measures_by_cosine(spark, sf_dir):
    records = vectors(spark, sf_dir)
    pairs = lk.candidate_pairs(signed_vectors(spark, sf_dir, 8), alike=["model", "content"])
    labelled = lk.label_pairs(pairs, records, "model")
    side = records.select("id", "vector")
    scored = (
        labelled.join(side.toDF("id_a", "va"), "id_a").join(side.toDF("id_b", "vb"), "id_b")
        .select("label", "pairs", lk.cosine(F.col("va"), F.col("vb")).alias("p"))
    )
    truth = records.groupBy("model").count().agg(
        F.sum(F.col("count") * (F.col("count") - 1) / 2)).scalar()
    out = pair_measures(scored, "label", "p", truth, SAME_MODEL, F.col("pairs"))
    exact = ["tp", "tn", "fp", "fn", "pairs", "duplicates"]
    return out.select(*exact, *[r(c, 8).alias(c) for c in out.columns if c not in exact])


# Thresholds and plane seeds of the sweep.
TARGETS = (0.0, 0.002, 0.07, 0.3, 0.6, 0.81, 0.92, 0.97, 0.99, 0.998)
SEEDS = (1, 2, 3, 4, 5)


#: Numbers of a band from which on its cells grow with the data.
LONG_BAND = 8


def sweep_settings() -> list[tuple[float, int, int, float]]:
    """(target, bands, rows, threshold) of every target."""
    return [(t, *lk.choose_bands(LENGTH, t)) for t in TARGETS]


@query("band_choice", "I2", f"""
with cuts as (select cast(b as integer) as bands, cast({LENGTH} // b as integer) as rows,
                     power(1.0 / b, 1.0 / ({LENGTH} // b)) as threshold
              from range(1, {LENGTH} + 1) t(b) where {LENGTH} % b = 0),
targets as (select unnest({list(TARGETS)}::double[]) as target),
held as (select target, bands, rows, threshold, n, row_number() over (partition by target order by threshold) as k
         from targets join cuts on threshold > target, (select count(*) as n from embeddings))
select target, bands, rows, round(threshold, 9) as threshold, cast(ceil(log2(8 * n)) as integer) as planes from held where k = 1
union all select target, 1, {LENGTH}, 1.0, cast(ceil(log2(8 * n)) as integer) from targets, (select count(*) as n from embeddings)
where target not in (select target from held)""")
def band_choice(spark, sf_dir):
    planes = lk.plane_count(table(spark, sf_dir, "embeddings").count())
    rows = [(t, *lk.choose_bands(LENGTH, t), planes) for t in TARGETS]
    return spark.createDataFrame(rows, "target double, bands int, rows int, threshold double, planes int").withColumn(
        "threshold", r("threshold", 9))


def _sweep_sql() -> str:
    parts = ["""
vectors as (select vec_id as id, embedding as vector, label as model, null as shop, null as brand, null as content from embeddings)"""]
    selects, settings = [], sweep_settings()
    for bands in sorted({c[1] for c in settings}):
        for seed in SEEDS:
            name = f"s{bands}_{seed}"
            parts.append(signature_sql(bands, seed, name))
            parts.append(f"""
{name}_pairs as (
  select distinct a.id as id_a, b.id as id_b, a.model = b.model as hit from {name} a join {name} b
    on a.band = b.band and a.hash = b.hash and a.id < b.id)""")
            selects.append(f"""
  select {bands} as bands, count(*) as candidates, count(*) filter (hit) as found from {name}_pairs""")
    rows = ", ".join(f"({t}::double, {b}, {th!r}::double)" for t, b, _, th in settings)
    return f"""
with {','.join(parts)},
truth as (select sum(n * (n - 1) / 2) as duplicates from (select count(*) as n from embeddings group by label)),
runs as ({' union all '.join(selects)}),
settings(target, bands, threshold) as (values {rows}),
q as (select bands, coalesce(found / nullif(candidates, 0), 0) as pq, found / duplicates as pc from runs, truth)
select target, bands, round(max(threshold), 6) as threshold, round(avg(pq), 8) as pair_quality,
       round(avg(pc), 8) as pair_completeness,
       round(avg(coalesce(2 * pq * pc / nullif(pq + pc, 0), 0)), 8) as f1_star
from q join settings using (bands) group by target, bands"""


@query("threshold_sweep", "D16 I2 I13", _sweep_sql())
def threshold_sweep(spark, sf_dir):
    """All cuts and seeds are signed in one pass over the vectors.

    Long bands are counted from the list of candidate pairs of classes. The few cells of short
    bands bring nearly all pairs together; those are counted without being listed.
    """
    stored = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("model"))
    points, settings = stored.count(), sweep_settings()
    runs = [(bands, seed) for bands in sorted({c[1] for c in settings}) for seed in SEEDS]
    short = [i for i, (bands, _) in enumerate(runs) if LENGTH // bands < LONG_BAND]
    signed = stage(bc.all_signatures(stored, ["id", "model"], "vector", runs, LENGTH, points), "signed")
    listed = signed.filter(~F.col("run").isin(short)).withColumn("bands", F.size("hashes"))
    pairs = lk.label_pairs(lk.candidate_pairs(listed, same=["run"], alike=["bands", "model"]), stored, "model")
    by_run = pairs.groupBy("run").agg(
        F.sum("pairs").alias("candidates"), F.sum(F.when(F.col("label") == 1, F.col("pairs")).otherwise(0)).alias("found"))
    by_run = by_run.unionByName(bc.any_band_totals(signed.filter(F.col("run").isin(short)), "model", ["run"]))
    duplicates = stored.groupBy("model").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("duplicates")).scalar()
    cuts = spark.createDataFrame([(i, bands) for i, (bands, _) in enumerate(runs)], "run int, bands int")
    rates = cuts.join(by_run, "run", "left").fillna(0).select(
        "bands", rate("found", "candidates").alias("pq"), rate(F.col("found"), duplicates).alias("pc"))
    chosen = spark.createDataFrame([(t, b, th) for t, b, _, th in settings], "target double, bands int, threshold double")
    return chosen.join(rates, "bands").groupBy("target", "bands").agg(
        r(F.max("threshold"), 6).alias("threshold"), r(F.avg("pq"), 8).alias("pair_quality"),
        r(F.avg("pc"), 8).alias("pair_completeness"),
        r(F.avg(harmonic(F.col("pq"), F.col("pc"))), 8).alias("f1_star"))


@query("many_band_totals", "C12 I2 I12", f"""
with {VECTORS_SQL}, {signature_sql(32)},
p as (select distinct a.id as id_a, b.id as id_b, a.brand as brand, a.model = b.model as hit from sig a join sig b
      on a.band = b.band and a.hash = b.hash and a.brand = b.brand and a.shop <> b.shop and a.id < b.id)
select brand, count(*) as candidates, count(*) filter (hit) as found from p group by brand""")
def many_band_totals(spark, sf_dir):
    """Exact counts over 32 short bands by brand, for pairs of different shops."""
    return bc.any_band_totals(signed_vectors(spark, sf_dir, 32), "model", ["brand"], "shop").filter("candidates > 0")


@query("blocked_pair_totals", "C12 I6 I12", f"""
with {VECTORS_SQL}, {signature_sql(8)},
p as (select distinct a.id as id_a, b.id as id_b, a.model = b.model as hit from sig a join sig b
      on a.band = b.band and a.hash = b.hash and a.brand = b.brand and a.shop <> b.shop and a.id < b.id)
select count(*) as candidates, count(*) filter (hit) as found,
       (select cast(sum(n * (n - 1) / 2) as bigint) from (select count(*) as n from vectors group by model)) as duplicates
from p""")
def blocked_pair_totals(spark, sf_dir):
    return lk.pair_totals(signed_vectors(spark, sf_dir, 8), 8, "model", ["brand"], "shop")


def md5_term(word, size: int):
    """A term that DuckDB can work out as well."""
    return (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % size).cast("int")


@query("text_vectors", "I11", r"""
with words as (
  select doc_id, unnest(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \n\r\t]+'), lambda x: x <> '')) as w
  from documents),
counts as (select doc_id, ('0x' || substr(md5(w), 1, 8))::bigint % 4096 as term, count(*) as c from words group by 1, 2),
weights as (select term, ln(((select count(*) from documents) + 1) / (count(*) + 1)) as idf from counts group by term),
v as (select doc_id, term, c * idf as weight from counts join weights using (term))
select d.doc_id, count(term) as terms, coalesce(sum(term), 0)::bigint as term_sum, round(coalesce(sum(weight), 0), 5) as weight_sum,
       round(sqrt(coalesce(sum(weight * weight), 0)), 5) as norm, arg_max(term, (round(weight, 9), -term))::bigint as heaviest
from documents d left join v on d.doc_id = v.doc_id group by d.doc_id""")
def text_vectors(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x["weight"])
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x["weight"] * x["weight"])
    ranked = F.transform("vector", lambda x: F.struct(F.round(x["weight"], 9).alias("w"), (-x["term"]).alias("t")))
    return lk.text_vectors(docs, "text", term=md5_term).select(
        "doc_id", F.size("vector").cast("long").alias("terms"),
        F.aggregate("vector", F.lit(0).cast("long"), lambda a, x: a + x["term"]).alias("term_sum"),
        r(total, 5).alias("weight_sum"), r(F.sqrt(squares), 5).alias("norm"),
        (-F.array_max(ranked)["t"]).cast("long").alias("heaviest"))
