"""Queries of the reference's own operators over the whole test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import chars
from ..functions import text as X
from ..operators import classify, estimate, lexicon, matching, quality, search, similarity
from ..session import table
from ..sources import io
from ..streaming import limiter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _lex(s, d):
    return table(s, d, "unified_lexicon")


def _docs(s, d):
    return table(s, d, "documents")


def _ref(s, d):
    r = table(s, d, "reference_headwords")
    return r.select(F.explode(F.array("t_main", "t_subword")).alias("term")).where(F.length("term") > 0).distinct()


_REF = "(SELECT DISTINCT term FROM (SELECT t_main AS term FROM reference_headwords UNION ALL SELECT t_subword FROM reference_headwords) WHERE term <> '')"
_STRIP = "regexp_replace(coalesce({}, ''), '^[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+|[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+$', '', 'g')"


def _strip(c: str) -> str:
    return _STRIP.format(c)


# --- script functions ------------------------------------------------------------------------


# RE2 has no \X; in these texts a cluster is a Khmer syllable, a line end of two characters, or a character with its marks.
_BASE, _MN = "[\\x{1780}-\\x{17B3}]", "[\\p{Mn}\\x{200D}]"
_CLUSTER = f"{_BASE}(?:{_MN}*\\x{{17D2}}{_MN}*{_BASE})*[\\p{{M}}\\x{{200C}}\\x{{200D}}]*|\\r\\n|[^\\r\\n\\x00-\\x1f\\x{{200B}}\\x{{00AD}}\\x{{2060}}\\x{{FEFF}}][\\p{{M}}\\x{{200C}}\\x{{200D}}]*|(?s:.)"


@query(f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{_CLUSTER}')) AS BIGINT) AS clusters FROM documents")
def cluster_len_documents(s, d):
    return _docs(s, d).select("doc_id", X.cluster_length(F.col("text")).alias("clusters"))


@query(f"SELECT pos_ord, array_to_string(regexp_extract_all(khmer, '{_CLUSTER}'), '|') AS clusters FROM unified_lexicon WHERE khmer IS NOT NULL")
def clusters_lexicon(s, d):
    return _lex(s, d).where("khmer is not null").select("pos_ord", F.array_join(X.clusters(F.col("khmer")), "|").alias("clusters"))


@query(
    f"WITH c AS (SELECT pos_ord, regexp_extract_all(khmer, '{_CLUSTER}') AS c FROM unified_lexicon WHERE khmer IS NOT NULL)"
    " SELECT pos_ord, coalesce((SELECT sum(b) FROM (SELECT unnest(list_transform(range(0, len(c) + 1), lambda n: length(array_to_string(c[1:n], '')))) AS b)), 0)::BIGINT AS total, len(c) + 1 AS n FROM c"
)
def boundaries_lexicon(s, d):
    b = X.cluster_boundaries(F.col("khmer"))
    total = F.aggregate(b, F.lit(0).cast("long"), lambda a, x: a + x)
    return _lex(s, d).where("khmer is not null").select("pos_ord", total.alias("total"), F.size(b).cast("long").alias("n"))


# Marks of a syllable in the order robat, subscripts, shifter, vowel, sign: six extractions put back together.
_SYL = "[\\x{1780}-\\x{17B3}](?:\\x{17D2}[\\x{1780}-\\x{17B3}]?|[\\x{17B6}-\\x{17D1}\\x{17DD}])*|(?s:.)"
_MARKS = "\\x{17D2}[\\x{1780}-\\x{17B3}]|(?s:.)"


def _canonical(c: str) -> str:
    classes = ("\\x{17CC}", "\\x{17D2}", "[\\x{17C9}\\x{17CA}]", "[\\x{17B6}-\\x{17C5}]", "[\\x{17C6}-\\x{17C8}\\x{17CB}\\x{17CD}-\\x{17D1}\\x{17DD}]")
    rest = f"regexp_extract_all(y[2:], '{_MARKS}')"
    parts = " || ".join(f"array_to_string(list_filter({rest}, lambda m: regexp_matches(m, '^{k}')), '')" for k in classes)
    return f"array_to_string(list_transform(regexp_extract_all({c}, '{_SYL}'), lambda y: CASE WHEN length(y) > 2 AND regexp_matches(y, '^[\\x{{1780}}-\\x{{17B3}}]') THEN y[1:1] || {parts} ELSE y END), '')"


@query(f"SELECT pos_ord, {_canonical('khmer')} AS khmer FROM unified_lexicon")
def canonical_marks_lexicon(s, d):
    return _lex(s, d).select("pos_ord", X.canonical_marks(F.col("khmer")).alias("khmer"))


# The search key of each letter, written out for the SQL on its own.
_KEYS = (
    "ក k ខ kh គ k ឃ kh ង ng ច ch ឆ ch ជ ch ឈ ch ញ nh ដ d ឋ th ឌ d ឍ th ណ n ត t ថ th ទ t ធ th ន n ប b ផ ph ព p ភ ph ម m យ y រ r ល l វ v ស s ហ h ឡ l អ a ឣ a ឤ a"
    " ឥ e ឦ e ឧ o ឩ o ឪ ov ឫ r ឬ r ឭ l ឮ l ឯ ae ឰ ai ឱ ao ឲ ao ឳ au ា a ិ i ី i ឹ eu ឺ eu ុ u ូ u ួ uo ើ ae ឿ ea ៀ ie េ e ែ ae ៃ ai ោ ao ៅ au ំ m ះ h ៌ r ័ a"
).split()


def _doubles(c: str) -> str:
    """Doubled pairs of letters once, then doubled letters once: RE2 has no back references, so the text is walked."""
    three = "right(acc, 3) || x"
    # a bar stands behind what a match has used up; only the same pair again goes on with it
    pairs = (
        f"replace(list_reduce(list_prepend('', string_split({c}, '')), lambda acc, x: CASE WHEN length(acc) >= 3 AND regexp_matches({three}, '^[a-z]{{4}}$')"
        f" AND substring({three}, 1, 2) = substring({three}, 3, 2) THEN left(acc, length(acc) - 1) || '|'"
        " WHEN length(acc) >= 4 AND substring(right(acc, 4), 3, 1) = '|' AND substring(right(acc, 4), 1, 2) = right(acc, 1) || x THEN left(acc, length(acc) - 1)"
        " ELSE acc || x END), '|', '')"
    )
    return f"list_reduce(list_prepend('', string_split({pairs}, '')), lambda acc, x: CASE WHEN right(acc, 1) = x THEN acc ELSE acc || x END)"


_TO_LATIN = "CASE y " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in zip(_KEYS[::2], _KEYS[1::2])) + " ELSE CASE WHEN regexp_matches(y, '^[A-Za-z0-9]$') THEN lower(y) ELSE '' END END"


def _roman(c: str) -> str:
    return _doubles(f"array_to_string(list_transform(string_split(translate({c}, '០១២៣៤៥៦៧៨៩', '0123456789'), ''), lambda y: {_TO_LATIN}), '')")


@query(f"SELECT pos_ord, {_roman('khmer')} AS latin FROM unified_lexicon WHERE khmer IS NOT NULL")
def romanize_lexicon(s, d):
    return _lex(s, d).where("khmer is not null").select("pos_ord", X.romanize(F.col("khmer")).alias("latin"))


@query("SELECT pos_ord, " + _doubles("regexp_replace(lower(english), '[^a-z0-9]+', '', 'g')") + " AS folded FROM unified_lexicon WHERE english IS NOT NULL")
def fold_latin_lexicon(s, d):
    return _lex(s, d).where("english is not null").select("pos_ord", X.fold_latin(F.col("english")).alias("folded"))


# The foreign characters that headwords of these tables hold and what they stand for.
_DRAWN = {"ิ": "ិ", "ี": "ី", "ึ": "ឹ", "ื": "ឺ", "\u030a": "ំ"}


@query(f"SELECT pos_ord, translate(khmer, '{''.join(_DRAWN)}', '{''.join(_DRAWN.values())}') AS khmer FROM unified_lexicon")
def repair_script_lexicon(s, d):
    return _lex(s, d).select("pos_ord", X.repair_script(F.col("khmer")).alias("khmer"))


_FOREIGN = "[^\\x00-\\x7F\\x{1780}-\\x{17FF}\\x{200B}-\\x{200D}\\x{2013}\\x{2014}\\x{2018}\\x{2019}\\x{201C}\\x{201D}\\x{2026}]"


@query(
    "WITH c AS (SELECT pos_ord, unnest(range(1, length(khmer) + 1)) AS i, khmer FROM unified_lexicon), f AS (SELECT pos_ord, i - 1 AS index, substring(khmer, i, 1) AS \"char\" FROM c)"
    f" SELECT pos_ord, index, \"char\", CASE WHEN strpos('{''.join(_DRAWN)}', \"char\") > 0 THEN 'UTS #39 visual confusable' ELSE 'outside Khmer, Latin and shared punctuation' END AS reason,"
    f" CASE WHEN strpos('{''.join(_DRAWN)}', \"char\") > 0 THEN translate(\"char\", '{''.join(_DRAWN)}', '{''.join(_DRAWN.values())}') ELSE '' END AS suggest FROM f WHERE regexp_matches(\"char\", '{_FOREIGN}')"
)
def contaminants_lexicon(s, d):
    return _lex(s, d).select("pos_ord", F.explode(X.contaminants(F.col("khmer"))).alias("c")).select("pos_ord", "c.index", "c.char", "c.reason", "c.suggest")


@query("SELECT pos_ord, length(regexp_replace(khmer, '[^A-Za-z0-9]', '', 'g')) AS n FROM unified_lexicon WHERE khmer IS NOT NULL")
def latin_in_headwords(s, d):
    latin = F.filter(X.contaminants(F.col("khmer"), False), lambda c: c["reason"] == X.LATIN)
    return _lex(s, d).where("khmer is not null").select("pos_ord", F.size(latin).cast("long").alias("n"))


@query("SELECT pos_ord, replace(replace(replace(khmer, '្ត', chr(1)), '្ដ', '្ត'), chr(1), '្ដ') AS swapped, replace(khmer, '្ដ', '្ត') AS folded FROM unified_lexicon")
def subscripts_lexicon(s, d):
    k = F.col("khmer")
    return _lex(s, d).select("pos_ord", X.swap_subscripts(k).alias("swapped"), X.fold_subscripts(k).alias("folded"))


@query(
    f"SELECT pos_ord, {_strip('regexp_replace(' + _strip('english') + ', ' + chr(39) + '^(?i:Eng[.]|H[.]|អ[.]|អង់[.])' + chr(92) + 's*' + chr(39) + ', ' + chr(39) * 2 + ')')} AS english FROM unified_lexicon"
)
def clean_english_lexicon(s, d):
    return _lex(s, d).select("pos_ord", X.clean_english(F.col("english")).alias("english"))


def _clean_khmer(c: str) -> str:
    t = _strip(f"regexp_replace({_strip(c)}, '^[\\x{{17E0}}-\\x{{17E9}}0-9]+[\\s\\->.)}}]*', '')")
    for wrong, right in (("កតិកាសញ្ញដ", "កតិកាសញ្ញា"), ("ដមារ", "ខ្មែរ"), ("ដមរា", "ខ្មែរ")):
        t = f"replace({t}, '{wrong}', '{right}')"
    return _strip(_canonical(f"translate({t}, '{''.join(_DRAWN)}', '{''.join(_DRAWN.values())}')"))


def _clean_gloss(c: str, marks: str) -> str:
    return _strip(f"regexp_replace({_strip(c)}, '^(?i:{marks})\\s*', '')")


_CLEAN = f"""SELECT pos_ord, {_clean_khmer('khmer')} AS khmer, {_clean_gloss('english', 'Eng[.]|H[.]|អ[.]|អង់[.]')} AS english,
  CASE WHEN regexp_matches({_strip('french')}, '^(?i:fr)($|[^\\pL.])') THEN {_clean_gloss('french', 'Fr')} ELSE {_clean_gloss('french', 'Fr[.]|បារ[.]')} END AS french, {_strip('pos')} AS pos FROM unified_lexicon"""
_CLEAN = f"SELECT * FROM ({_CLEAN}) WHERE (khmer <> '' OR english <> '') AND NOT (contains(khmer, 'រាជបណ្ឌិត្យសភាកម្ពុជា') OR contains(khmer, 'សូមថ្លែងអំណរគុណ') OR contains(khmer, 'CONCH'))"


@query(_CLEAN)
def clean_entries_lexicon(s, d):
    return lexicon.clean_entries(_lex(s, d)).select("pos_ord", "khmer", "english", "french", "pos")


_POS = """WITH p AS (SELECT pos_ord, lower(trim(coalesce(pos, ''))) AS k FROM unified_lexicon)
SELECT pos_ord, CASE WHEN k IN ('m', 'm.', '(m.)', 'f', 'f.', '(f.)', 'ន.', 'ន', 'noun', 'n.', 'n') THEN 'noun' WHEN k IN ('កិ.', 'កិ', 'verb', 'v.', 'v') THEN 'verb'
  WHEN k IN ('គុ.', 'adj.', 'adj', 'adjective') THEN 'adjective' WHEN k IN ('កិ.វិ.', 'adv.', 'adv', 'adverb') THEN 'adverb'
  WHEN k IN ('proper noun', 'country', 'capital', 'city', 'proper noun (country)', 'proper noun (capital)') THEN 'properNoun' END AS pos,
  CASE WHEN k IN ('m', 'm.', '(m.)') THEN 'masculine' WHEN k IN ('f', 'f.', '(f.)') THEN 'feminine' END AS gender FROM p"""


@query(_POS)
def parts_of_speech_lexicon(s, d):
    return _lex(s, d).select("pos_ord", X.part_of_speech(F.col("pos")).alias("p")).select("pos_ord", "p.*")


@query(
    "WITH y AS (SELECT doc_id, list_filter(list_transform(list_filter(string_split_regex(translate(coalesce(text, ''), '០១២៣៤៥៦៧៨៩', '0123456789'), '[^0-9]+'),"
    " lambda r: length(r) = 4), lambda r: CAST(r AS INTEGER)), lambda r: r BETWEEN 1950 AND 2049) AS y FROM documents)"
    " SELECT doc_id, list_max(y) AS latest, len(y) AS n FROM y"
)
def years_documents(s, d):
    return _docs(s, d).select("doc_id", F.array_max(X.years(F.col("text"))).alias("latest"), F.size(X.years(F.col("text"))).cast("long").alias("n"))


@query("SELECT pos_ord, CASE WHEN trim(coalesce(english, '')) = '' THEN 'no English gloss in the source' END AS note FROM unified_lexicon")
def gloss_notes(s, d):
    return _lex(s, d).select("pos_ord", X.gloss_note(F.col("english")).alias("note"))


@query()
def confusable_table(s, d):
    return io.confusable_table(s)


# --- matching --------------------------------------------------------------------------------


@query(f"SELECT doc_id, term FROM documents, {_REF} t WHERE contains(text, term)")
def terms_present(s, d):
    return matching.terms_present(_docs(s, d), _ref(s, d))


@query(
    f"SELECT doc_id, term, CAST(i - 1 AS BIGINT) AS start, CAST(i - 1 + length(term) AS BIGINT) AS \"end\" FROM (SELECT doc_id, text, term, unnest(generate_series(1, length(text) - length(term) + 1)) AS i"
    f" FROM documents, {_REF} t WHERE contains(text, term)) WHERE substring(text, i, length(term)) = term"
)
def term_occurrences(s, d):
    return matching.occurrences(_docs(s, d), _ref(s, d))


_HITS = (
    f"SELECT doc_id, term, CAST(i - 1 AS BIGINT) AS s, CAST(i - 1 + length(term) AS BIGINT) AS e FROM (SELECT doc_id, text, term, unnest(generate_series(1, length(text) - length(term) + 1)) AS i"
    f" FROM documents, {{}} t WHERE contains(text, term)) WHERE substring(text, i, length(term)) = term"
)


def _longest(hits: str) -> str:
    """Hits without overlap: the sorted hits of a document are walked once."""
    walk = (
        "list_reduce(list_prepend([struct_pack(s := CAST(-1 AS BIGINT), m := CAST(0 AS BIGINT), e := CAST(0 AS BIGINT), term := '')], list_transform(h, lambda y: [y])),"
        " lambda acc, x: CASE WHEN x[1].s >= acc[-1].e THEN list_concat(acc, x)"
        " WHEN x[1].e > acc[-1].e AND x[1].e - x[1].s > acc[-1].e - acc[-1].s THEN list_concat(acc[1:len(acc) - 1], x) ELSE acc END)"
    )
    g = f"SELECT doc_id, list_sort(list(struct_pack(s := s, m := s - e, e := e, term := term))) AS h FROM ({hits}) GROUP BY doc_id"
    return f"SELECT doc_id, k.term AS term, k.s AS start, k.e AS \"end\" FROM (SELECT doc_id, unnest({walk}) AS k FROM ({g})) WHERE k.s >= 0"


@query(_longest(_HITS.format(_REF)))
def longest_matches(s, d):
    return matching.longest_matches(matching.occurrences(_docs(s, d), _ref(s, d)))


_STOP = ", ".join(f"'{w}'" for w in matching.STOP_WORDS)
_TERMS = (
    f"(SELECT {_strip('khmer')} AS term, count(*) AS n_senses FROM unified_lexicon WHERE regexp_matches({_strip('khmer')}, '[\\x{{1780}}-\\x{{17FF}}]')"
    f" AND len(regexp_extract_all({_strip('khmer')}, '{_CLUSTER}')) >= 2 AND {_strip('khmer')} NOT IN ({_STOP}) GROUP BY 1)"
)
_CHECKED = f"""WITH t AS {_TERMS}, raw AS ({_HITS.format('t')}),
c AS (SELECT doc_id, regexp_extract_all(text, '{_CLUSTER}') AS c FROM documents),
b AS (SELECT doc_id, unnest(list_prepend(0, list_transform(range(1, len(c) + 1), lambda n: 0))) AS zero FROM c WHERE false),
e AS (SELECT doc_id, 0 AS b FROM c UNION ALL SELECT doc_id, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS b FROM (SELECT doc_id, length(unnest(c)) AS n, unnest(range(1, len(c) + 1)) AS i FROM c)),
kept AS (SELECT raw.* FROM raw JOIN e x ON x.doc_id = raw.doc_id AND x.b = s JOIN e y ON y.doc_id = raw.doc_id AND y.b = e),
final AS ({_longest('SELECT * FROM kept')})"""
_CHECKED = _CHECKED.replace("b AS (SELECT doc_id, unnest(list_prepend(0, list_transform(range(1, len(c) + 1), lambda n: 0))) AS zero FROM c WHERE false),\n", "")


@query(_CHECKED + ' SELECT doc_id, term, start, "end", n_senses FROM final JOIN t USING (term)')
def check_drafts_matches(s, d):
    return matching.check_drafts(_docs(s, d), _lex(s, d))["matches"].select("doc_id", "term", "start", "end", F.size("senses").cast("long").alias("n_senses"))


@query(
    _CHECKED + ", n AS (SELECT doc_id, (SELECT count(*) FROM raw WHERE raw.doc_id = d.doc_id) AS raw, (SELECT count(*) FROM kept WHERE kept.doc_id = d.doc_id) AS kept,"
    " (SELECT count(*) FROM final WHERE final.doc_id = d.doc_id) AS matches FROM documents d) SELECT doc_id, raw, raw - kept AS rejected, matches, kept - matches AS merged FROM n"
)
def check_drafts_counters(s, d):
    return matching.check_drafts(_docs(s, d), _lex(s, d))["counters"]


_LOANS = f"""WITH x AS (SELECT lower({_strip('english')}) AS term, {_strip('khmer')} AS khmer, pos_ord FROM unified_lexicon),
t AS (SELECT term, arg_min(khmer, pos_ord) AS khmer FROM x WHERE length(term) >= 4 AND regexp_full_match(term, '[\\x00-\\x7F]*') AND khmer <> '' GROUP BY term),
docs AS (SELECT doc_id, text, lower(text) AS low FROM documents),
h AS (SELECT doc_id, term, khmer, text, low, CAST(i - 1 AS BIGINT) AS s, CAST(i - 1 + length(term) AS BIGINT) AS e FROM (SELECT doc_id, text, low, term, khmer, unnest(generate_series(1, length(low) - length(term) + 1)) AS i
  FROM docs, t WHERE contains(low, term) AND NOT contains(text, khmer)) WHERE substring(low, i, length(term)) = term),
w AS (SELECT doc_id, term, s, e FROM h WHERE NOT regexp_matches(CASE WHEN s > 0 THEN substring(low, s, 1) ELSE '' END, '[\\pL\\pN]') AND NOT regexp_matches(substring(low, e + 1, 1), '[\\pL\\pN]')),
f AS ({_longest('SELECT * FROM w')})
SELECT doc_id, substring(text, start + 1, "end" - start) AS term, start, "end", khmer AS suggest FROM f JOIN t USING (term) JOIN docs USING (doc_id)"""


@query(_LOANS)
def loanwords(s, d):
    return matching.loanwords(_docs(s, d), matching.english_terms(_lex(s, d)))


@query(
    "WITH e AS (SELECT lower(" + _strip("english") + ") AS term, " + _strip("khmer") + " AS khmer, pos_ord FROM unified_lexicon)"
    " SELECT term, arg_min(khmer, pos_ord) AS khmer FROM e WHERE length(term) >= 4 AND regexp_full_match(term, '[\\x00-\\x7F]*') AND khmer <> '' GROUP BY term"
)
def english_terms(s, d):
    return matching.english_terms(_lex(s, d))


@query(f"SELECT count(*) + 1 AS nodes FROM (SELECT DISTINCT substring(term, 1, n) FROM (SELECT term, unnest(generate_series(1, length(term))) AS n FROM {_REF} t))")
def automaton_size(s, d):
    return matching.automaton_size(_ref(s, d))


@query("SELECT source, author, year, count(*) AS n_entries, count(DISTINCT nullif(" + _strip("khmer") + ", '')) AS n_forms FROM unified_lexicon GROUP BY ALL")
def about(s, d):
    return matching.about(_lex(s, d))


@query(f"SELECT term, bool_or(found) AS found FROM (SELECT term, EXISTS (SELECT 1 FROM documents WHERE contains(text, term)) AS found FROM {_REF} t) GROUP BY term")
def planted_terms(s, d):
    return similarity.planted_terms(_docs(s, d), _ref(s, d))


# --- search ----------------------------------------------------------------------------------

_TIERS = """SELECT pos_ord, tier, CAST(row_number() OVER (ORDER BY tier, k, pos_ord) AS INTEGER) AS rank FROM (
  SELECT pos_ord, tier, CASE tier WHEN 1 THEN 0 WHEN 3 THEN length(coalesce(khmer, ''))
    ELSE length(CASE WHEN coalesce(english, '') <> '' THEN english ELSE coalesce(khmer, '') END) END AS k
  FROM (SELECT *, CASE WHEN {exact} THEN 1 WHEN {part} THEN 2 WHEN {loose} THEN 3 END AS tier FROM unified_lexicon))
WHERE tier IS NOT NULL ORDER BY rank LIMIT 60"""


@query(_TIERS.format(exact="lower(english) = 'of' OR lower(french) = 'of'", part="contains(lower(english), 'of') OR contains(lower(french), 'of')", loose="false"))
def search_latin(s, d):
    # two letters: too short for the search by sound
    return search.search(_lex(s, d), "of").select("pos_ord", "tier", "rank")


@query(_TIERS.format(exact="khmer = 'ភាព'", part="contains(khmer, 'ភាព')", loose="contains(definition, 'ភាព')"))
def search_khmer(s, d):
    return search.search(_lex(s, d), "ភាព").select("pos_ord", "tier", "rank")


# All three tiers of a Latin query; the third by the sound key of the headword, within distance two.
_SOUND = f"""WITH k AS (SELECT pos_ord, english, french, khmer, {_roman("coalesce(khmer, '')")} AS k FROM unified_lexicon), t AS (
  SELECT *, CASE WHEN contains(k, '{{f}}') THEN 0 ELSE levenshtein(k, '{{f}}') END AS near FROM k
), u AS (SELECT *, CASE WHEN lower(english) = '{{q}}' OR lower(french) = '{{q}}' THEN 1 WHEN contains(lower(english), '{{q}}') OR contains(lower(french), '{{q}}') THEN 2
    WHEN k <> '' AND near <= 2 THEN 3 END AS tier FROM t)
SELECT pos_ord, tier, CAST(row_number() OVER (ORDER BY tier, CASE tier WHEN 3 THEN near WHEN 2 THEN length(CASE WHEN coalesce(english, '') <> '' THEN english ELSE coalesce(khmer, '') END) ELSE 0 END,
  CASE WHEN tier = 3 THEN length(khmer) ELSE 0 END, pos_ord) AS INTEGER) AS rank FROM u WHERE tier IS NOT NULL ORDER BY rank LIMIT 60"""


@query(_SOUND.replace("{f}", "mang").replace("{q}", "mang"))
def search_by_sound(s, d):
    return search.search(_lex(s, d), "mang").select("pos_ord", "tier", "rank")


@query(f"SELECT author, count(*) AS n FROM (SELECT {_strip('author')} AS author FROM unified_lexicon) WHERE author <> '' GROUP BY author")
def authors(s, d):
    return search.authors(_lex(s, d))


@query("SELECT count(*) AS total FROM unified_lexicon WHERE category = 'Land Survey' AND (contains(lower(english), 'code') OR contains(lower(french), 'code'))")
def search_category_total(s, d):
    # the folded query is four letters, so sound-alike headwords would count as well: only the first two tiers are asked for
    return search.search(_lex(s, d), "code", "Land Survey", 2_000_000_000).where("tier < 3").agg(F.count("*").alias("total"))


_ONE_OFF = (
    "CASE WHEN length({0}) = length({1}) THEN len(list_filter(range(1, length({0}) + 1), lambda i: substring({0}, i, 1) <> substring({1}, i, 1))) <= 1"
    " WHEN length({0}) = length({1}) + 1 THEN list_bool_or(list_transform(range(1, length({0}) + 1), lambda i: substring({0}, 1, i - 1) || substring({0}, i + 1) = {1}))"
    " WHEN length({0}) + 1 = length({1}) THEN list_bool_or(list_transform(range(1, length({1}) + 1), lambda i: substring({1}, 1, i - 1) || substring({1}, i + 1) = {0})) ELSE false END"
)
# Clusters become single characters of a private plane, so that the distance of characters is that of clusters.
_DID_YOU_MEAN = f"""WITH t AS (SELECT DISTINCT query_text AS f, true AS asked FROM search_log WHERE kind = 'zero_result' AND regexp_matches(query_text, '[\\x{{1780}}-\\x{{17FF}}]')
  UNION SELECT DISTINCT {_strip('khmer')}, false FROM unified_lexicon WHERE {_strip('khmer')} <> ''),
c AS (SELECT f, asked, regexp_extract_all({_canonical("trim(f, ' ' || chr(9) || chr(10) || chr(160))")}, '{_CLUSTER}') AS c FROM t),
n AS (SELECT k, row_number() OVER (ORDER BY k) AS n FROM (SELECT DISTINCT unnest(c) AS k FROM c)),
w AS (SELECT f, asked, string_agg(chr(CAST(983040 + n AS INTEGER)), '' ORDER BY i) AS w FROM (SELECT f, asked, unnest(c) AS k, unnest(range(1, len(c) + 1)) AS i FROM c) JOIN n USING (k) GROUP BY f, asked),
m AS (SELECT x.f AS query, y.f AS khmer, CASE WHEN x.w = y.w THEN 0 ELSE 1 END AS distance FROM w x JOIN w y ON x.asked AND NOT y.asked AND abs(length(x.w) - length(y.w)) <= 1 AND {_ONE_OFF.format('x.w', 'y.w')})
SELECT query, khmer, CAST(distance AS INTEGER) AS distance, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY distance, length(khmer), khmer) AS INTEGER) AS rank FROM m) WHERE rank <= 6"""


@query(_DID_YOU_MEAN)
def did_you_mean(s, d):
    asked = table(s, d, "search_log").where("kind = 'zero_result'").select(F.col("query_text").alias("query"))
    return search.did_you_mean(_lex(s, d), asked)


@query("SELECT category, count(*) AS n, min(pos_ord) AS first_pos FROM unified_lexicon WHERE category <> '' GROUP BY category")
def categories(s, d):
    return search.categories(_lex(s, d))


@query("SELECT source, count(*) AS n, arg_min(coalesce(author, ''), pos_ord) AS author, arg_min(coalesce(year, ''), pos_ord) AS year FROM unified_lexicon WHERE source <> '' GROUP BY source")
def sources(s, d):
    return search.sources(_lex(s, d))


@query(
    "SELECT letter, count(*) AS n FROM (SELECT DISTINCT " + _strip("khmer") + " AS k, substring(" + _strip("khmer") + ", 1, 1) AS letter FROM unified_lexicon)"
    " WHERE regexp_matches(letter, '[\\x{1780}-\\x{17FF}]') GROUP BY letter"
)
def letters(s, d):
    return search.letters(_lex(s, d))


@query("SELECT pos_ord, khmer FROM unified_lexicon WHERE source = (SELECT min(source) FROM unified_lexicon) ORDER BY pos_ord LIMIT 200")
def by_source(s, d):
    first = _lex(s, d).agg(F.min("source")).first()[0]
    return search.by_source(_lex(s, d), first).select("pos_ord", "khmer")


@query("SELECT pos_ord, khmer FROM unified_lexicon WHERE starts_with(khmer, 'ក') ORDER BY khmer, pos_ord LIMIT 200")
def by_letter(s, d):
    return search.by_letter(_lex(s, d), "ក").select("pos_ord", "khmer")


_COVER = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER ({_strip(c)} <> '') AS filled, count(*) FILTER ({_strip(c)} <> '') / count(*) AS share FROM unified_lexicon"
    for c in ("english", "khmer", "french", "pos", "definition", "examples")
)


@query(_COVER)
def field_coverage(s, d):
    return search.field_coverage(_lex(s, d))


@query(
    "SELECT min(TRY_CAST(year AS INTEGER)) FILTER (regexp_full_match(year, '[0-9]+')) AS first_year, max(TRY_CAST(year AS INTEGER)) FILTER (regexp_full_match(year, '[0-9]+')) AS last_year,"
    f" count(DISTINCT nullif({_strip('author')}, '')) AS n_authors FROM unified_lexicon"
)
def year_span(s, d):
    return search.year_span(_lex(s, d))


@query(
    "WITH s AS (SELECT source, count(*) AS n, arg_min(coalesce(author, ''), pos_ord) AS author, arg_min(coalesce(year, ''), pos_ord) AS year FROM unified_lexicon WHERE source <> '' GROUP BY source)"
    " SELECT s.source, n, author, s.year, title, nullif(coalesce(official_url, ''), '') AS link, coalesce(nullif(url_status, ''), 'unknown') AS url_status,"
    " coalesce(nullif(url_status, ''), 'unknown') = 'archived-only' AS archived_only FROM s LEFT JOIN source_registry r USING (source)"
)
def registry_report(s, d):
    return search.registry_report(_lex(s, d), table(s, d, "source_registry"))


@query("SELECT DISTINCT word, english, khmer, source FROM unified_lexicon, (VALUES ('tax'), ('code'), ('hearing')) w(word) WHERE regexp_matches(lower(english), '(^|[^\\pL\\pN\\pM_])' || word || '($|[^\\pL\\pN\\pM_])')")
def whole_word(s, d):
    return search.whole_word(_lex(s, d), ["tax", "code", "hearing"])


@query(
    "SELECT doc_id, CAST(i - 1 AS INTEGER) AS at, trim(c, ' ' || chr(9) || chr(13) || chr(160)) AS context FROM (SELECT doc_id, unnest(c) AS c, unnest(range(1, len(c) + 1)) AS i FROM"
    " (SELECT doc_id, regexp_extract_all(text, '(?i)[^.\\n]*?draft[^.\\n]*?\\.') AS c FROM documents))"
)
def contexts(s, d):
    return search.contexts(_docs(s, d), "draft")


@query(
    "SELECT lower(english) AS english_key, arg_min(khmer, pos_ord) AS khmer, min(pos_ord) AS pos FROM unified_lexicon WHERE "
    + _strip("english") + " <> '' AND " + _strip("khmer") + " <> '' GROUP BY 1"
)
def lookup_english(s, d):
    return search.lookups(_lex(s, d))[0]


# --- similarity ------------------------------------------------------------------------------


def _glosses(s, d):
    g = F.lower(F.col("english"))
    return _lex(s, d).select(g.alias("form")).where(F.col("form").rlike("^[\\x00-\\x7F]+$")).distinct()


_GLOSS = "(SELECT DISTINCT lower(english) AS f FROM unified_lexicon WHERE regexp_full_match(english, '[\\x00-\\x7F]+'))"


@query(f"SELECT x.f AS a, y.f AS b FROM {_GLOSS} x, {_GLOSS} y WHERE x.f < y.f AND abs(length(x.f) - length(y.f)) <= 1 AND levenshtein(x.f, y.f) = 1")
def near_glosses(s, d):
    return similarity.near_forms(_glosses(s, d), unit="character")


# Clusters become single characters of a private plane, so that the distance of characters is that of clusters.
_NEAR_HEADWORDS = f"""WITH g AS (SELECT DISTINCT khmer AS f, lower({_strip('english')}) AS g FROM unified_lexicon WHERE khmer <> ''),
c AS (SELECT f, regexp_extract_all(f, '{_CLUSTER}') AS c FROM (SELECT DISTINCT f FROM g)),
n AS (SELECT k, row_number() OVER (ORDER BY k) AS n FROM (SELECT DISTINCT unnest(c) AS k FROM c)),
w AS (SELECT f, string_agg(chr(CAST(983040 + n AS INTEGER)), '' ORDER BY i) AS w FROM (SELECT f, unnest(c) AS k, unnest(range(1, len(c) + 1)) AS i FROM c) JOIN n USING (k) GROUP BY f)
SELECT DISTINCT x.f AS a, y.f AS b FROM g x JOIN g y ON x.g = y.g AND x.g <> '' AND x.f < y.f JOIN w p ON p.f = x.f JOIN w q ON q.f = y.f
WHERE p.w <> q.w AND abs(length(p.w) - length(q.w)) <= 1 AND {_ONE_OFF.format('p.w', 'q.w')}"""


@query(_NEAR_HEADWORDS)
def near_headword_pairs(s, d):
    return similarity.near_forms_with_gloss(_lex(s, d), "khmer", "english")


@query()
def near_headwords(s, d):
    return similarity.classify_pairs(similarity.near_forms_with_gloss(_lex(s, d), "khmer", "english"))


@query("SELECT khmer AS form, count(*) AS n FROM unified_lexicon WHERE khmer <> '' GROUP BY khmer HAVING count(*) > 1")
def duplicate_forms(s, d):
    return similarity.duplicate_forms(_lex(s, d), "khmer")


_WORDS = f"(SELECT DISTINCT w AS word FROM (SELECT {_canonical(_strip('t_main'))} AS w FROM reference_headwords UNION ALL SELECT {_canonical(_strip('t_subword'))} FROM reference_headwords) WHERE w <> '')"
_SINGLE = f"(SELECT pos_ord, {_canonical(_strip('khmer'))} AS k FROM unified_lexicon WHERE regexp_matches({_strip('khmer')}, '[\\x{{1780}}-\\x{{17FF}}]') AND NOT regexp_matches({_strip('khmer')}, '[ /()]'))"


@query(f"SELECT pos_ord FROM {_SINGLE} WHERE replace(k, '្ដ', '្ត') IN (SELECT replace(word, '្ដ', '្ត') FROM {_WORDS})")
def known_headwords(s, d):
    words = similarity.headwords(table(s, d, "reference_headwords"))
    return similarity.known_words(similarity.single_words(_lex(s, d)), words).select("pos_ord")


# Positions that can be reached from the start by list words of two clusters or more.
_COMPOUNDS = f"""WITH RECURSIVE w AS {_WORDS}, e AS (SELECT pos_ord, regexp_extract_all(k, '{_CLUSTER}') AS p FROM {_SINGLE}), b AS (SELECT * FROM e WHERE len(p) >= 4),
r(pos_ord, p, i) AS (SELECT pos_ord, p, CAST(0 AS BIGINT) FROM b UNION SELECT pos_ord, p, j FROM (SELECT pos_ord, p, i, unnest(range(i + 2, len(p) + 1)) AS j FROM r)
  WHERE array_to_string(p[i + 1:j], '') IN (SELECT word FROM w))
SELECT DISTINCT pos_ord FROM r WHERE i = len(p)"""


@query(_COMPOUNDS)
def compounds(s, d):
    return similarity.compounds(similarity.single_words(_lex(s, d)), similarity.headwords(table(s, d, "reference_headwords")), "pos_ord")


@query()
def suspects(s, d):
    return similarity.suspects(_lex(s, d), similarity.headwords(table(s, d, "reference_headwords")), "pos_ord")


@query()
def subscript_worklist(s, d):
    return similarity.subscript_worklist(_lex(s, d), similarity.headwords(table(s, d, "reference_headwords")), "pos_ord")


# --- building, quality -----------------------------------------------------------------------


@query("SELECT min(pos_ord) AS pos_ord FROM unified_lexicon GROUP BY lower(coalesce(english, '')) || '|' || lower(coalesce(khmer, ''))")
def dedup_first_wins(s, d):
    return lexicon.first_wins(_lex(s, d), lexicon.pair_key(), "pos_ord").select("pos_ord")


@query("SELECT pos_ord, 'official_lex_' || printf('%04d', row_number() OVER (ORDER BY pos_ord)) AS id FROM unified_lexicon")
def assign_ids(s, d):
    return lexicon.with_ids(_lex(s, d), "pos_ord").select("pos_ord", "id")


_BUILT = f"""WITH c AS ({_CLEAN}), f AS (SELECT *, row_number() OVER (PARTITION BY lower(english) || '|' || lower(khmer) ORDER BY pos_ord) AS r FROM c)
SELECT pos_ord, 'official_lex_' || printf('%04d', row_number() OVER (ORDER BY pos_ord)) AS id, khmer, english FROM f WHERE r = 1"""


@query(_BUILT)
def build_lexicon(s, d):
    return lexicon.build(_lex(s, d), "pos_ord").select("pos_ord", "id", "khmer", "english")


_RO_LAST = "regexp_replace({}, '([\\x{{1780}}-\\x{{17A2}}])\\x{{17D2}}\\x{{179A}}\\x{{17D2}}([\\x{{1780}}-\\x{{17A2}}])', '\\1្\\2្រ', 'g')"
_MERGED = f"""WITH kept AS (SELECT lower(coalesce(english, '')) || '|' || lower(coalesce(khmer, '')) AS key FROM unified_lexicon l WHERE source NOT IN (SELECT source FROM staged_entries WHERE source IS NOT NULL) OR source IS NULL),
s AS (SELECT raw_id, {_RO_LAST.format(_clean_khmer('khmer'))} AS k, {_clean_gloss('english', 'Eng[.]|H[.]|អ[.]|អង់[.]')} AS e FROM staged_entries),
j AS (SELECT *, lower(e) || '|' || lower(k) AS key, (k = '' AND e = '') OR (k <> '' AND (NOT regexp_matches(k, '[\\x{{1780}}-\\x{{17FF}}]') OR regexp_matches(k, '[0-9]') OR regexp_matches(k, '{_FOREIGN}')
  OR len(regexp_extract_all(k, '{_CLUSTER}')) > 30 OR regexp_full_match(k, '[\\x{{1780}}-\\x{{17A2}}]'))) OR contains(k, 'រាជបណ្ឌិត្យសភាកម្ពុជា') OR contains(k, 'សូមថ្លែងអំណរគុណ') OR contains(k, 'CONCH') AS bad FROM s)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN bad THEN 'skipped' WHEN key IN (SELECT key FROM kept) OR row_number() OVER (PARTITION BY bad, key ORDER BY raw_id) > 1 THEN 'duplicate' ELSE 'added' END AS status FROM j) GROUP BY status"""


@query(_MERGED)
def append_merge_stats(s, d):
    return lexicon.append_merge(_lex(s, d), table(s, d, "staged_entries"), "raw_id")[1]


def _flat(c: str) -> str:
    return _strip(f"regexp_replace(coalesce({c}, ''), '[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}]+', ' ', 'g')")


_TIDY = f"""WITH f AS (SELECT raw_id, item, needs_review, {_flat('khmer')} AS k, {_flat('english')} AS e, {_flat('french')} AS fr, {_flat('pos')} AS p, {_flat('definition')} AS d, {_flat('examples')} AS x FROM staged_entries),
g AS (SELECT * REPLACE (CASE WHEN regexp_matches(e, '[\\x{{1780}}-\\x{{17FF}}]') AND NOT regexp_matches(e, '[A-Za-z]') THEN '' ELSE e END AS e,
  CASE WHEN regexp_matches(fr, '[\\x{{1780}}-\\x{{17FF}}]') AND NOT regexp_matches(fr, '[A-Za-z]') THEN '' ELSE fr END AS fr,
  regexp_replace(regexp_replace(k, '([\\x{{1780}}-\\x{{17DD}}])-\\s+([\\x{{1780}}-\\x{{17DD}}])', '\\1\\2', 'g'), '([\\x{{1780}}-\\x{{17DD}}])-\\s+([\\x{{1780}}-\\x{{17DD}}])', '\\1\\2', 'g') AS k) FROM f),
i AS (SELECT *, regexp_extract(k, '^\\s*([\\x{{17E0}}-\\x{{17E9}}0-9]+)\\s*[-\\x{{2013}}\\x{{2014}}.]\\s*', 1) AS no, {_strip("regexp_replace(k, '^' || chr(92) || 's*[០-៩0-9]+' || chr(92) || 's*[-–—.]' || chr(92) || 's*', '')")} AS rest FROM g)
SELECT raw_id, rest AS khmer, coalesce(nullif({_strip('item')}, ''), no) AS item, CASE WHEN rest = '' THEN 'headword not read by OCR' ELSE needs_review END AS needs_review FROM i
WHERE rest <> '' OR e <> '' OR fr <> '' OR p <> '' OR d <> '' OR x <> ''"""


@query(_TIDY)
def tidy_extracted(s, d):
    return lexicon.tidy_extracted(table(s, d, "staged_entries")).select("raw_id", "khmer", "item", "needs_review")


_K = _strip("khmer")
_CHECKS = f"""WITH e AS (SELECT {_K} AS k, {_strip('english')} AS e FROM unified_lexicon), c AS (
  SELECT 'empty khmer' AS "check", count(*) FILTER (k = '') AS n FROM e
  UNION ALL SELECT 'empty english', count(*) FILTER (e = '') FROM e
  UNION ALL SELECT 'no Khmer at all', count(*) FILTER (k <> '' AND NOT regexp_matches(k, '[\\x{{1780}}-\\x{{17FF}}]')) FROM e
  UNION ALL SELECT 'ASCII digit', count(*) FILTER (regexp_matches(k, '[0-9]')) FROM e
  UNION ALL SELECT 'shorter than three characters', count(*) FILTER (regexp_matches(k, '[\\x{{1780}}-\\x{{17FF}}]') AND length(k) < 3) FROM e
  UNION ALL SELECT 'single bare consonant', count(*) FILTER (regexp_full_match(k, '[\\x{{1780}}-\\x{{17A2}}]')) FROM e
  UNION ALL SELECT 'duplicate khmer forms', (SELECT count(*) FROM (SELECT k FROM e WHERE k <> '' GROUP BY k HAVING count(*) > 1))
  UNION ALL SELECT 'duplicate english glosses', (SELECT count(*) FROM (SELECT lower(e) FROM e WHERE e <> '' GROUP BY 1 HAVING count(*) > 1))
) SELECT "check", n FROM c WHERE n > 0"""


@query(_CHECKS)
def validate_simple(s, d):
    names = ["empty khmer", "empty english", "no Khmer at all", "ASCII digit", "shorter than three characters", "single bare consonant", "duplicate khmer forms", "duplicate english glosses"]
    return quality.check_counts(_lex(s, d), "pos_ord").where(F.col("check").isin(names))


_BAD = "[^\\x00-\\x7F\\x{1780}-\\x{17FF}\\x{200B}-\\x{200D}\\x{2013}\\x{2014}\\x{2018}\\x{2019}\\x{201C}\\x{201D}\\x{2026}]"
_ALL_CHECKS = _CHECKS.replace(') SELECT "check", n FROM c WHERE n > 0', f"""  UNION ALL SELECT 'subscript ro first', count(*) FILTER (regexp_matches(k, '[\\x{{1780}}-\\x{{17A2}}]\\x{{17D2}}\\x{{179A}}\\x{{17D2}}[\\x{{1780}}-\\x{{17A2}}]')) FROM e
  UNION ALL SELECT 'letter pair for a vowel', count(*) FILTER (contains(k, 'ប្ញ')) FROM e
  UNION ALL SELECT 'marks not in canonical order', count(*) FILTER ({_canonical('k')} <> k) FROM e
  UNION ALL SELECT 'longer than 20 clusters', count(*) FILTER (len(regexp_extract_all(k, '{_CLUSTER}')) > 20) FROM e
  UNION ALL SELECT 'out-of-range character', CAST(sum(len(regexp_extract_all(k, '{_BAD}'))) AS BIGINT) FROM e
  UNION ALL SELECT 'obsolete letter', CAST(sum(contains(k, 'ឝ')::INT + contains(k, 'ឞ')::INT + contains(k, 'ឣ')::INT + contains(k, 'ឤ')::INT) AS BIGINT) FROM e
) SELECT "check", n FROM c WHERE n > 0""")


@query(_ALL_CHECKS)
def validate_checks(s, d):
    return quality.check_counts(_lex(s, d), "pos_ord")


@query(f"SELECT CAST(pos_ord AS VARCHAR) AS id, substring(sha256(coalesce({_canonical('khmer')}, '')), 1, 8) AS hash FROM unified_lexicon")
def build_index(s, d):
    return quality.build_index(_lex(s, d), "pos_ord")


@query(
    "SELECT substring(sha256('{' || string_agg('\"' || id || '\": \"' || hash || '\"', ', ' ORDER BY id) || '}'), 1, 12) AS build_id FROM"
    f" (SELECT CAST(pos_ord AS VARCHAR) AS id, substring(sha256(coalesce({_canonical('khmer')}, '')), 1, 8) AS hash FROM unified_lexicon)"
)
def build_id(s, d):
    return quality.build_id(quality.build_index(_lex(s, d), "pos_ord"))


@query("SELECT id, CASE WHEN a IS NULL THEN 'added' WHEN b IS NULL THEN 'removed' ELSE 'khmer_changed' END AS change FROM"
       " (SELECT id, min(coalesce(khmer, '')) AS a FROM unified_lexicon WHERE load_no <= 4 GROUP BY id) x FULL JOIN (SELECT id, min(coalesce(khmer, '')) AS b FROM unified_lexicon WHERE load_no >= 4 GROUP BY id) y USING (id)"
       " WHERE a IS DISTINCT FROM b")  # fmt: skip
def build_diff(s, d):
    one = lambda c: _lex(s, d).where(c).groupBy("id").agg(F.min(F.coalesce("khmer", F.lit(""))).alias("hash"))
    return quality.build_diff(one("load_no <= 4"), one("load_no >= 4"))


# --- estimation ------------------------------------------------------------------------------


@query(
    "WITH s AS (SELECT source, count(*) AS size, sum(count(*)) OVER () AS total FROM unified_lexicon GROUP BY source),"
    " a AS (SELECT source, least(greatest(10, CAST(round_even(300 * size / total, 0) AS BIGINT)), size) AS take FROM s)"
    " SELECT pos_ord FROM (SELECT pos_ord, take, row_number() OVER (PARTITION BY source ORDER BY sha256('20260907|' || pos_ord), pos_ord) AS r FROM unified_lexicon JOIN a USING (source)) WHERE r <= take"
)
def stratified_draw(s, d):
    return estimate.draw(_lex(s, d), 300, "source", "pos_ord").select("pos_ord")


def _judged(s, d):
    log = table(s, d, "search_log").where("kind = 'zero_result'")
    return log.select(F.coalesce("category", F.lit("")).alias("category"), F.when(F.col("had_suggestions"), "y").otherwise("n").alias("ok"))


_JUDGED = "(SELECT coalesce(category, '') AS stratum, count(*) FILTER (had_suggestions IS DISTINCT FROM TRUE) AS errors, count(*) AS checked FROM search_log WHERE kind = 'zero_result' GROUP BY 1)"


@query(
    "SELECT stratum, errors, checked, round(p, 9) AS p, round(greatest(0, (p + 1.9208 / n) / (1 + 3.8416 / n) - h), 9) AS lo, round(least(1, (p + 1.9208 / n) / (1 + 3.8416 / n) + h), 9) AS hi FROM"
    " (SELECT *, 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n) AS h FROM (SELECT *, errors / checked AS p, CAST(checked AS DOUBLE) AS n FROM " + _JUDGED + "))"
)
def wilson_by_category(s, d):
    t = estimate.tally(_judged(s, d), "ok", "category").withColumn("w", estimate.wilson(F.col("errors"), F.col("checked")))
    return t.select("stratum", "errors", "checked", *[F.round(F.col(f"w.{x}"), 9).alias(x) for x in ("p", "lo", "hi")])


@query(
    "WITH r AS (SELECT sum(size * errors / checked) / sum(size) AS rate, CAST(sum(checked) AS DOUBLE) AS n, CAST(sum(size) AS BIGINT) AS covers"
    " FROM " + _JUDGED + " JOIN (SELECT coalesce(category, '') AS stratum, count(*) AS size FROM unified_lexicon GROUP BY 1) USING (stratum)),"
    " p AS (SELECT *, round_even(rate * n, 0) / n AS p FROM r), h AS (SELECT *, 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n) AS h FROM p)"
    " SELECT round(rate, 9) AS rate, CAST(n AS BIGINT) AS n, covers, round((p + 1.9208 / n) / (1 + 3.8416 / n) - h, 9) AS lo, round((p + 1.9208 / n) / (1 + 3.8416 / n) + h, 9) AS hi FROM h"
)
def weighted_rate(s, d):
    sizes = _lex(s, d).groupBy(F.coalesce("category", F.lit("")).alias("stratum")).agg(F.count("*").alias("size"))
    r = estimate.weighted_rate(estimate.tally(_judged(s, d), "ok", "category"), sizes)
    return r.select(F.round("rate", 9).alias("rate"), "n", "covers", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"))


@query()
def gloss_lines(s, d):
    pages = table(s, d, "staged_entries").groupBy("source", "page").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("Eng. "), F.coalesce("english", F.lit(""))))), "\n").alias("text"))
    return estimate.locate_glosses(_lex(s, d), pages, "pos_ord")


# --- documents, exports, events --------------------------------------------------------------


_KIND = [
    ("ព្រះរាជក្រឹត្យ", "law-or-decree"), ("ព្រះរាជក្រម", "law-or-decree"), ("អនុក្រឹត្យ", "law-or-decree"), ("សេចក្តីសម្រេច", "law-or-decree"), ("ប្រកាស", "law-or-decree"),
    ("សារាចរ", "law-or-decree"), ("ព្រឹត្តិបត្រ", "bulletin"), ("BULLETIN", "bulletin"), ("សទ្ទានុក្រម", "terminology-glossary"), ("LEXICON", "terminology-glossary"), ("វចនានុក្រម", "dictionary"),
    ("វេយ្យាករណ៍", "grammar"), ("របាយការណ៍", "report"),
]
_CLASSIFIED = """WITH l AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x{85}\\x{2028}\\x{2029}]'), lambda x: trim(x) <> '')[1:12] AS l, text FROM documents),
k AS (SELECT doc_id, array_to_string(l, ' / ') AS title, replace(upper(array_to_string(l, ' ')), '្ដ', '្ត') AS u, list_filter(list_transform(list_filter(string_split_regex(translate(coalesce(text, ''), '០១២៣៤៥៦៧៨៩', '0123456789'), '[^0-9]+'),
  lambda r: length(r) = 4), lambda r: CAST(r AS INTEGER)), lambda r: r BETWEEN 1950 AND 2049) AS y FROM l),
w AS (SELECT * FROM (VALUES """ + ", ".join(f"('{w}', '{k}')" for w, k in _KIND) + """) v(word, kind)),
h AS (SELECT doc_id, min(struct_pack(at := strpos(u, replace(upper(word), '្ដ', '្ត')), word := word, kind := kind)) FILTER (strpos(u, replace(upper(word), '្ដ', '្ត')) > 0) AS h FROM k, w GROUP BY doc_id)
SELECT doc_id AS doc, coalesce(h.kind, CASE WHEN trim(u) <> '' THEN 'other' ELSE 'indeterminate' END) AS kind, h.word AS word, nullif(title, '') AS title_area, list_max(y) AS year FROM k JOIN h USING (doc_id)"""


@query(_CLASSIFIED)
def classify_documents(s, d):
    return classify.classify_documents(_docs(s, d).select(F.col("doc_id").alias("doc"), F.lit(1).alias("page"), "text"))


@query()
def tbx_export(s, d):
    return io.tbx_concepts(_lex(s, d))


# The window of accepted events walks along each user's events; what is rejected uses up nothing.
_LIMITED = """WITH e AS (SELECT user_id, list(struct_pack(id := event_id, t := epoch_us(ts)) ORDER BY ts, event_id) AS l FROM events GROUP BY user_id),
r AS (SELECT user_id, list_reduce(list_prepend([struct_pack(id := CAST(-1 AS BIGINT), t := CAST(0 AS BIGINT), ok := false)], list_transform(l, lambda y: [struct_pack(id := y.id, t := y.t, ok := false)])),
  lambda acc, x: list_concat(acc, [struct_pack(id := x[1].id, t := x[1].t, ok := len(list_filter(acc[greatest(1, len(acc) - 400):], lambda z: z.ok AND z.t >= x[1].t - 21600000000)) < 3)])) AS a FROM e)
SELECT k.id AS event_id, CAST(user_id AS VARCHAR) AS client, k.ok AS accepted FROM (SELECT user_id, unnest(a) AS k FROM r) WHERE k.id >= 0"""


@query(_LIMITED)
def rate_limit_events(s, d):
    return limiter.rate_limit(table(s, d, "events"), "user_id", "ts", "event_id", 3, 21_600)


@query("SELECT query_text AS query, count(*) AS n FROM search_log WHERE kind = 'zero_result' AND query_text IS NOT NULL GROUP BY 1 ORDER BY n DESC, query LIMIT 40")
def zero_result_topk(s, d):
    return limiter.top_misses(table(s, d, "search_log"), "query_text", 40, F.col("kind") == "zero_result")
