"""The registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matrixq.llm import (
    bpe,
    forest,
    lattice,
    licenses,
    lines,
    minhash,
    mixing,
    suffixes,
    topk,
    toxicity,
    urls,
    variants,
    whitening,
)
from matrixq.llm.common import table, written

#: Vocabulary files of public tokenizers.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: Rules of the URL query: verdict, host and path.
URL_RULES = [
    ("block", "net", "/"), ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"), ("allow", "org", "/fr/"),
]
#: Listed junk sites, each below the three reserved example domains.
JUNK_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
JUNK_DOMAINS = ("example.com", "example.net", "example.org")


def op1_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings", "vec_id", "embedding")
    return topk.search(vectors, F.col("vec_id") % 100 == 0)


def op2_urls(spark: SparkSession, d: str) -> DataFrame:
    rows = [(host, path, verdict, False) for verdict, host, path in URL_RULES]
    rows += [(f"{s}.{x}", "/", "block", True) for s in JUNK_SITES for x in JUNK_DOMAINS]
    entries = spark.createDataFrame(
        rows, "host string, path string, verdict string, listed boolean"
    )
    pages = table(spark, d, "pages", "page_id", "url")
    return urls.judge(pages, entries).drop("url")


def op3_suffixes(spark: SparkSession, d: str) -> DataFrame:
    left = suffixes.dedup(table(spark, d, "documents", "doc_id", "text"))
    return left.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_bpe(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    done = bpe.encode(docs, WORD_TOKENIZER, decoded="decoded")
    return done.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_lines(spark: SparkSession, d: str) -> DataFrame:
    left = lines.dedup(table(spark, d, "documents", "doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def toxicity_model(spark: SparkSession, docs: DataFrame, d: str) -> toxicity.Model:
    """Learned from the labels of rows that are not held out."""
    labels = table(spark, d, "labels", "doc_id", "toxic")
    return toxicity.learn(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, d))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_forest(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings", "vec_id", "embedding")
    return forest.search(vectors, F.col("vec_id") % 20 == 0)


def op8_minhash(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text")
    return minhash.near_duplicates(docs, 85).drop("first")


def op9_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents", "doc_id", "text")).drop("spans")


def op10_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "source", "text")
    sizes = written(mixing.sized(docs).select("doc_id", "source", "size"), "sizes")
    return mixing.mix(sizes).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op11_lattice(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents", "doc_id", "text", "lang")
    model = lattice.learn(docs, lattice.Vocabulary.read(PIECES), of_class="lang")
    return lattice.score(docs, model)


def op12_variants(spark: SparkSession, d: str) -> DataFrame:
    return variants.group(table(spark, d, "documents", "doc_id", "text"))


def op13_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings", "vec_id", "embedding"))


_OP1_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 10
"""


_OP5_SQL = f"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
split as (select doc_id, string_split(text, chr(10)) as l from docs),
pos as (select doc_id, l, unnest(range(1, len(l) + 1)) as place from split),
each as (select doc_id, place, l[place] as line from pos where l[place] <> ''),
firsts as (select line, min((doc_id, place)) as first, length(line) as n from each group by line),
near as (
  select distinct b.first
  from firsts a join firsts b on a.first < b.first and a.n between b.n - 2 and b.n + 2
  where least(a.n, b.n) >= {lines.CHARS_PER_EDIT}
    and (left(a.line, a.n // 3) = left(b.line, a.n // 3)
      or right(a.line, a.n // 3) = right(b.line, a.n // 3)
      or contains(b.line, a.line[a.n // 3 + 1 : a.n - a.n // 3]))
    and levenshtein(a.line, b.line)
      <= least({lines.EDITS}, a.n // {lines.CHARS_PER_EDIT}, b.n // {lines.CHARS_PER_EDIT})),
kept as (select e.doc_id, list(e.line order by e.place) as l
  from each e join firsts f on e.line = f.line and f.first = (e.doc_id, e.place)
  where f.first not in (select first from near) group by e.doc_id)
select d.doc_id, cast(len(list_filter(s.l, lambda x: x <> '')) as bigint) as n_lines,
  cast(len(list_filter(s.l, lambda x: x <> '')) - len(coalesce(k.l, [])) as bigint) as n_removed,
  sha256(case when len(list_filter(s.l, lambda x: x <> '')) = len(coalesce(k.l, [])) then d.text
    else array_to_string(coalesce(k.l, []), chr(10)) end) as kept_sha256
from docs d join split s using (doc_id) left join kept k using (doc_id)
"""
_OP8_SQL = """
with recursive docs as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [w]
    else list_transform(range(1, len(w) - 3), lambda i: w[i : i + 4]) end) as s from docs),
each as (select doc_id, len(s) as n, unnest(s) as x from sets),
pairs as (select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as shared
  from each a join each b on a.x = b.x and a.doc_id <> b.doc_id group by all),
links as (select a, b from pairs where 100 * shared >= 85 * (na + nb - shared)),
walk as (select doc_id as a, doc_id as b from docs
  union select walk.a, links.b from walk join links on walk.b = links.a),
tops as (select a as doc_id, min(b) as component_id from walk group by a)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join tops using (doc_id)
"""


def _op2_sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for v, h, p in URL_RULES)
    junk = ", ".join(f"'{s}.{x}'" for s in JUNK_SITES for x in JUNK_DOMAINS)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with rules(rhost, rpath, verdict) as (values {rules}),
parts as (
  select page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
              '{letters}', '{letters.lower()}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
pairs as (select distinct host, path from parts),
best as (
  select host, path, max_by(rhost || rpath, length(rhost || rpath)) as rule,
    max_by(verdict, length(rhost || rpath)) as verdict
  from pairs join rules
    on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by host, path),
junk as (select unnest([{junk}]) as jhost),
hits as (select distinct host, path from pairs join junk
  on (host = jhost or ends_with(host, '.' || jhost)) and starts_with(path, '/'))
select p.page_id, p.host, p.path, b.rule,
  coalesce(b.verdict, case when h.host is null then 'allow' else 'block' end) as verdict
from parts p left join best b using (host, path) left join hits h using (host, path)
"""


def _op9_sql() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def words(text: str) -> str:
        low = f"translate(coalesce({text}, ''), '{letters}', '{letters.lower()}')"
        return f"regexp_extract_all({low}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

    phrases = []
    for label, phrase in licenses.PHRASES.items():
        each = phrase.split()
        test = " and ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(each))
        phrases.append(
            f"select k, '{label}' as label, i - 1 as place from places where {test}"
        )
    templates = ", ".join(
        f"('{label}', {sorted(set(licenses.words_of(text)))})"
        for label, text in licenses.TEMPLATES
    )
    return f"""
with docs as (select row_number() over () as k, doc_id, text, {words("text")} as w from documents),
places as (select k, w, unnest(range(1, len(w) + 1)) as i from docs),
found as ({" union all ".join(phrases)}),
base as (select k, count(*) as n_base, min(place) as first_word, max(place) as last_word,
  list_distinct(list(label)) as base from found group by k),
lines as (select k, list_distinct({words("line")}) as w
  from (select k, unnest(string_split(coalesce(text, ''), chr(10))) as line from docs)),
templates(label, t) as (values {templates}),
fits as (
  select k, label, len(list_intersect(w, t)) / len(t) as share
  from lines join templates on list_has_any(w, t)
  where len(list_intersect(w, t)) >= ceil({licenses.CONTAINMENT} * len(t) - 1e-9)),
own as (select k, list_distinct(list(label)) as own, max(share) as share from fits group by k)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base,
  cast(first_word as bigint) as first_word, cast(last_word as bigint) as last_word,
  coalesce(array_to_string(list_sort(base), ','), '') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ',')
    as labels,
  case when n_base > 0 then 1.0::double else coalesce(share, 0.0)::double end as score
from docs left join base using (k) left join own using (k)
"""


def _op12_sql() -> str:
    """The checksum is worked out byte by byte from its polynomial's table."""
    checks = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        checks.append(value)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
with recursive crc as (select {checks}::ubigint[] as t),
runs as (
  select coalesce(cast(doc_id as varchar), '') as id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) as run
  from documents),
each as (select id, run, count(*) as n from runs where length(run) >= 6 group by id, run),
coded as (
  select run, n, flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
    case when unicode(c) < 128 then [unicode(c)] else [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] end))
    ::ubigint[] as b from each),
hashed as (
  select run, n, xor(list_reduce(b, lambda a, x: xor(a >> 8, t[cast((xor(a, x) & 255) + 1 as bigint)]), 4294967295::ubigint),
    4294967295::ubigint) as h from coded, crc),
placed as (select run, n, h, cast(h % length(run) as bigint) as k from hashed),
words as (
  select case when h % 199 = 0 then left(run, k) || substr(run, k + 2) else run end as word, sum(n) as n
  from placed group by 1),
v as (select word, cast(n as bigint) as n from words where length(word) >= 6 and n >= 5),
places as (select word, n, unnest(range(length(word))) as k from v),
rests as (select word, n, k, left(word, k) as a, substr(word, k + 2) as b from places),
near as (
  select x.word, y.word as near, y.n as near_n from rests x join rests y using (a, b) where x.word <> y.word
  union select r.word, v.word, v.n from rests r join v on v.word = r.a || r.b
  union select v.word, r.word, r.n from rests r join v on v.word = r.a || r.b),
best as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n
  from near group by word),
forms as (
  select word, n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * n then near end as form,
    case when near_n >= 5 * n then near_n end as form_n from v left join best using (word)),
walk as (
  select word, word as root, 0 as steps from forms
  union all select w.word, f.form, w.steps + 1 from walk w join forms f on w.root = f.word where f.form is not null),
roots as (select word, max_by(root, steps) as root from walk group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)
"""


QUERIES = {
    "op1_topk": op1_topk,
    "op2_urls": op2_urls,
    "op3_suffixes": op3_suffixes,
    "op4_bpe": op4_bpe,
    "op5_lines": op5_lines,
    "op6_toxicity": op6_toxicity,
    "op7_forest": op7_forest,
    "op8_minhash": op8_minhash,
    "op9_licenses": op9_licenses,
    "op10_mixing": op10_mixing,
    "op11_lattice": op11_lattice,
    "op12_variants": op12_variants,
    "op13_whitening": op13_whitening,
}
ORACLES = {
    "op1_topk": _OP1_SQL,
    "op2_urls": _op2_sql(),
    "op5_lines": _OP5_SQL,
    "op8_minhash": _OP8_SQL,
    "op9_licenses": _op9_sql(),
    "op12_variants": _op12_sql(),
}
