"""Text functions on documents, pages and part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import matcher
from granary.plans.query import Registry
from granary.session import table

R = Registry()


_EDGES = "' ' || chr(9) || chr(10) || chr(13) || '\"''`.,;:!?()[]{}<>'"


@R.query(f"""SELECT doc_id, md5(trim(trim(trim(regexp_replace(translate(lower(strip_accents(text)), '-_', '  '), '\\s+', ' ', 'g')), {_EDGES}))) AS normalized_md5 FROM documents""")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.normalize(F.col("text"))).alias("normalized_md5"))


@R.query("SELECT p_name, array_to_string(list_sort(list_distinct(list_filter(string_split(p_name, ' '), lambda w: w NOT IN ('wild', 'american')))), ' ') AS tokens FROM (SELECT DISTINCT p_name FROM part)")
def token_sets(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_name").distinct().select("p_name", F.array_join(X.token_set(F.col("p_name")), " ").alias("tokens"))


@R.query("""WITH s AS (SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(CASE WHEN p_size % 2 = 0 THEN p_name ELSE string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1] END, ' '))), ' ') AS words FROM part)
SELECT words, count(*) AS n_cards FROM s GROUP BY 1 HAVING count(*) > 1""")
def token_set_collisions(spark, sf_dir):
    words = F.split("p_name", " ")
    turned = F.when(F.col("p_size") % 2 == 0, F.col("p_name")).otherwise(F.concat_ws(" ", words[1], words[0]))
    cards = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("card_id"), turned.alias("accepted"), F.lit("full").alias("kind"))
    return matcher.token_collisions(cards)


@R.query("""SELECT page_id, md5(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ')) AS text_md5 FROM pages""")
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(X.strip_tags(F.col("html"))).alias("text_md5"))


@R.query("""SELECT page_id, trim(regexp_replace(regexp_replace(nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ''), '<[^>]+>', ' ', 'g'), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ') AS heading FROM pages""")
def html_first_tag(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.first_element(F.col("html"), "h1").alias("heading"))


@R.query("SELECT page_id, 'https://host/photos/' || page_id || '/medium.jpeg?v=2' AS url FROM pages")
def sized_urls(spark, sf_dir):
    url = F.concat(F.lit("https://host/photos/"), F.col("page_id"), F.lit("/square.jpeg?v=2"))
    return table(spark, sf_dir, "pages").select("page_id", X.sized_url(url, "medium").alias("url"))


@R.query("SELECT a.p_name AS a, b.p_name AS b, damerau_levenshtein(a.p_name, b.p_name)::INT AS distance FROM (SELECT DISTINCT p_name FROM part) a JOIN (SELECT DISTINCT p_name FROM part) b ON a.p_name < b.p_name WHERE damerau_levenshtein(a.p_name, b.p_name) <= 4")
def edit_distance_pairs(spark, sf_dir):
    return matcher.pairs_within(table(spark, sf_dir, "part").select("p_name"), "p_name", 4)


@R.query("SELECT c_custkey, greatest(1, length(c_name) // 6)::INT AS threshold FROM customer")
def edit_thresholds(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", X.edit_threshold(F.col("c_name")).alias("threshold"))


@R.query("SELECT DISTINCT word, replace(replace(word, 'c', 'k'), 'll', 'l') AS spelled, true AS alike FROM (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)")
def phonetic_pairs(spark, sf_dir):
    """Words of part names that sound alike under a changed spelling."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    said = words.select("word", F.regexp_replace(F.regexp_replace("word", "c", "k"), "ll", "l").alias("spelled"))
    coded = said.withColumn("a", X.phonetic_codes(F.col("word"))).withColumn("b", X.phonetic_codes(F.col("spelled")))
    return coded.select("word", "spelled", X.sounds_alike(F.col("a"), F.col("b")).alias("alike"))


@R.query("SELECT s_suppkey, string_split(s_name || ' var major', ' ')[1] || ' var' AS binomial FROM supplier")
def binomials(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.binomial(F.concat("s_name", F.lit(" var  major"))).alias("binomial"))


@R.query("SELECT n_nationkey, replace(lower(n_name), '_', ' x ') AS loose FROM nation")
def loose_names(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", X.loose_name(F.replace("n_name", F.lit("_"), F.lit(" × x  "))).alias("loose"))
