"""DuckDB SQL twins of the registered checks (views: the driver's tables).

Written independently of the Spark plans: the lexicon twin unnests words
and reads preceding words with ``lag`` windows, where the Spark plan carries
them in-row. Shared are only the fixed values (word lists, constants).

DuckDB rounds small negative values to -0.0 where Spark gives 0.0, so
rounded results add 0.0 (which turns -0.0 into 0.0).
"""

from __future__ import annotations

from tonality.fixed import (ABBREVIATION_SCORE, BOOSTER_DAMPING, BUT_AFTER, BUT_BEFORE, CAPS_INCREMENT,
                            COLLOCATION_SCORE,
                            EXCLAMATION_MAX, EXCLAMATION_WEIGHT, FACTOR_DAMPING, NEGATION_SCALAR,
                            NEGATION_SUFFIX, NEUTRAL_BAND, NLTK_ENGLISH_STOP_WORDS,
                            NORMALIZATION_ALPHA, PERIOD_GIVEN_ABBREVIATION, PUNCTUATION, QUESTION_MANY,
                            QUESTION_WEIGHT, SPLIT_SEED, SPLIT_WEIGHTS, STARTER_SCORE)
from tonality.functions.text import default_stop_words
from tonality.operators.resampling import LEVEL, REPLICATES, draw_thresholds
from tonality.plans.checks import (FIXTURE_BOOSTERS, FIXTURE_LEXICON, FIXTURE_NEGATORS,
                                   FIXTURE_PHRASES, HEADER, LONG_REVIEW, METRIC_DIGITS)
from tonality.sources.scores import SCORE_LINE


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"({x!r})::DOUBLE"


def str_list(words) -> str:
    return "[" + ", ".join(lit(w) for w in dict.fromkeys(words)) + "]::VARCHAR[]"


REVIEWS = f"""reviews AS (
  SELECT d.source AS business_id, CAST(NULL AS BIGINT) AS cool, CAST(NULL AS VARCHAR) AS "date",
         CAST(NULL AS BIGINT) AS funny, CAST(d.doc_id AS VARCHAR) AS review_id,
         CAST(CASE WHEN l.quality = 1 AND l.toxic = 0 THEN 5 WHEN l.quality = 1 AND l.toxic = 1 THEN 3
                   WHEN l.quality = 0 AND l.toxic = 0 THEN 2 WHEN l.quality = 0 AND l.toxic = 1 THEN 1
              END AS DOUBLE) AS stars,
         d.text AS text, CAST(NULL AS BIGINT) AS useful, CAST(NULL AS VARCHAR) AS user_id
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

THREE_CLASS = "CAST(CASE WHEN stars < 3 THEN 1 WHEN stars > 3 THEN 3 WHEN stars = 3 THEN 2 END AS DOUBLE)"
BINARY = "CAST(CASE WHEN stars > 3 THEN 1 WHEN stars <= 3 THEN 0 END AS DOUBLE)"


def tokens(text: str = "text") -> str:
    return (f"CASE WHEN regexp_matches({text}, '^\\s+$') THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array(regexp_replace(lower({text}), '\\s+$', ''), '\\s') END")


def without(arr: str, words) -> str:
    return f"list_filter({arr}, lambda t: NOT list_contains({str_list(words)}, lower(t)))"


def sentences(text: str = "text") -> str:
    trimmed = f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"
    marked = f"regexp_replace({trimmed}, '([.!?]+)\\s+', '\\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s <> '')"


def exploded(source: str, arr: str, pos: str = "pos", item: str = "token") -> str:
    return (f"SELECT doc_id, CAST(UNNEST(range(len(a))) AS BIGINT) AS {pos}, UNNEST(a) AS {item} "
            f"FROM (SELECT doc_id, {arr} AS a FROM {source})")


KEPT = f"kept AS (SELECT doc_id, {without(tokens(), NLTK_ENGLISH_STOP_WORDS)} AS a FROM documents WHERE text IS NOT NULL)"
TF = "tf AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, UNNEST(a) AS term FROM kept) GROUP BY doc_id, term)"
DF = "dfreq AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM (SELECT UNNEST(list_distinct(a)) AS term FROM kept) GROUP BY term)"
IDF = ("idf AS (SELECT term, df, CASE WHEN df >= 5 THEN ln((CAST((SELECT count(*) FROM kept) AS DOUBLE) + 1.0::DOUBLE)"
       " / (CAST(df AS DOUBLE) + 1.0::DOUBLE)) ELSE 0.0::DOUBLE END AS idf FROM dfreq)")


def _roles_values(phrases=()) -> str:
    roles: dict[str, list] = {}
    for w, v in FIXTURE_LEXICON:
        roles.setdefault(w.lower(), [None, None, False, None, False])[0] = v
    for w, b in FIXTURE_BOOSTERS:
        roles.setdefault(w.lower(), [None, None, False, None, False])[1] = b
    for w in FIXTURE_NEGATORS:
        roles.setdefault(w.lower(), [None, None, False, None, False])[2] = True
    for w, *given in phrases:
        held = roles.setdefault(w.lower(), [None, None, False, None, False])
        held[:] = [x if x not in (None, False) else h for x, h in zip(given, held)]

    def number(x):
        return dbl(x) if x is not None else "NULL::DOUBLE"

    rows = [f"({lit(w)}, {number(v)}, {number(b)}, {str(n).lower()}, {number(f)}, {str(x).lower()})"
            for w, (v, b, n, f, x) in roles.items()]
    return "roles(w, valence, incr, neg, factor, near) AS (VALUES " + ", ".join(rows) + ")"


def _merged_words(phrases) -> str:
    """``words`` with phrases merged, as CTE ``sm`` over ``s1``: unit lengths per word, then a
    string of what each unit still covers, whose zeros end units."""
    if not phrases:
        return ""
    long = [p[0] for p in phrases if " " in p[0]]
    length = "CASE " + " ".join(
        f"WHEN list_contains({str_list([p for p in long if p.count(' ') == n - 1])}, array_to_string(low[i:i + {n - 1}], ' ')) THEN {n}"
        for n in (4, 3, 2)) + " ELSE 1 END"
    return f"""
sl AS (SELECT *, list_transform(words, lambda x: lower(x)) AS low FROM s1),
sn AS (SELECT *, list_transform(range(1, len(low) + 1), lambda i: {length}) AS ns FROM sl),
sr AS (SELECT *, list_reduce(list_prepend('0', list_transform(ns, lambda x: (x - 1)::VARCHAR)),
       lambda a, x: a || CASE WHEN right(a, 1) > '0' THEN (right(a, 1)::INT - 1)::VARCHAR ELSE x END) AS r FROM sn),
sm AS (SELECT doc_id, sid, sentence, list_transform(list_filter(range(1, len(ns) + 1), lambda i: r[i] = '0'),
       lambda i: array_to_string(words[i:i + ns[i] - 1], ' ')) AS words FROM sr),"""


def _strip(x: str) -> str:
    stripped = f"trim({x}, {lit(PUNCTUATION)})"
    return f"CASE WHEN length({stripped}) <= 2 THEN {x} ELSE {stripped} END"


def _count(s: str, ch: str) -> str:
    return f"(length({s}) - length(replace({s}, {lit(ch)}, '')))"


def _signed(v: str, amount: float) -> str:
    return f"(CASE WHEN {v} > 0 THEN {dbl(amount)} ELSE {dbl(-amount)} END)"


def lexicon_ctes(source: str, phrases=()) -> str:
    """CTEs ending in ``sent_scores(doc_id, sid, compound, pos, neu, neg)`` and
    ``doc_scores(doc_id, vader, n)`` for ``source(doc_id, text)``."""
    bangs = f"least({_count('sentence', '!')}, {EXCLAMATION_MAX})"
    marks = _count("sentence", "?")
    punct = (f"{bangs} * {dbl(EXCLAMATION_WEIGHT)} + CASE WHEN {marks} <= 1 THEN 0.0::DOUBLE "
             f"WHEN {marks} <= 3 THEN {marks} * {dbl(QUESTION_WEIGHT)} ELSE {dbl(QUESTION_MANY)} END")
    steps = []
    prev = "v0"
    for d in range(1, 4):
        v = "v"
        scalar = (f"((CASE WHEN {v} < 0 THEN -r{d}b ELSE r{d}b END) + "
                  f"(CASE WHEN u{d} AND cap_diff THEN {_signed(v, CAPS_INCREMENT)} ELSE 0.0::DOUBLE END))")
        boosted = (f"({v} + CASE WHEN r{d}b IS NOT NULL THEN {scalar} * {dbl(BOOSTER_DAMPING[d - 1])} "
                   f"ELSE 0.0::DOUBLE END)")
        negated = f"(coalesce(r{d}n, false) OR contains(p{d}, {lit(NEGATION_SUFFIX)}))"
        if d == 1:
            negated = f"({negated} OR coalesce(r{d}x, false))"
        scaled = f"{boosted} * (1.0::DOUBLE + (r{d}f - 1.0::DOUBLE) * {dbl(FACTOR_DAMPING[d - 1])})"
        step = (f"CASE WHEN p{d} IS NOT NULL AND r{d}v IS NULL THEN "
                f"(CASE WHEN {negated} THEN {boosted} * {dbl(NEGATION_SCALAR)} "
                f"WHEN r{d}f IS NOT NULL THEN {scaled} ELSE {boosted} END) "
                f"ELSE {v} END")
        steps.append(f"v{d} AS (SELECT * REPLACE ({step} AS v) FROM {prev})")
        prev = f"v{d}"
    lags = ", ".join(f"lag(w, {d}) OVER win AS p{d}, lag(up, {d}) OVER win AS u{d}" for d in range(1, 4))
    joins = " ".join(f"LEFT JOIN roles r{d} ON r{d}.w = t2.p{d}" for d in range(1, 4))
    rcols = ", ".join(f"r{d}.valence AS r{d}v, r{d}.incr AS r{d}b, r{d}.neg AS r{d}n, "
                      f"r{d}.factor AS r{d}f, r{d}.near AS r{d}x" for d in range(1, 4))
    alpha = dbl(NORMALIZATION_ALPHA)

    def reduce(expr, cond):
        return (f"list_reduce(list({expr} ORDER BY pos) FILTER (WHERE {cond}), "
                f"lambda a, b: a + b, 0.0::DOUBLE)")

    return f""",
{_roles_values(phrases)},
s AS (SELECT doc_id, CAST(UNNEST(range(len(a))) AS BIGINT) AS sid, UNNEST(a) AS sentence
      FROM (SELECT doc_id, {sentences()} AS a FROM {source})),
s1 AS (SELECT doc_id, sid, sentence,
       list_transform(list_filter(regexp_split_to_array(sentence, '\\s+'), lambda x: x <> ''), lambda x: {_strip('x')}) AS words
       FROM s),{_merged_words(phrases)}
s2 AS (SELECT doc_id, sid, {punct} AS punct, list_transform(words, lambda x: lower(x)) AS lw,
       list_transform(words, lambda x: upper(x) = x AND lower(x) <> x) AS caps FROM {'sm' if phrases else 's1'}),
s3 AS (SELECT doc_id, sid, punct, lw, caps, len(lw) AS n_tok,
       len(lw) > 0 AND len(list_filter(caps, lambda c: c)) > 0 AND len(list_filter(caps, lambda c: c)) < len(lw) AS cap_diff,
       coalesce(list_position(lw, 'but'), 0) - 1 AS but_at FROM s2),
t AS (SELECT doc_id, sid, cap_diff, but_at, UNNEST(range(len(lw))) AS pos, UNNEST(lw) AS w, UNNEST(caps) AS up FROM s3),
t2 AS (SELECT *, {lags} FROM t WINDOW win AS (PARTITION BY doc_id, sid ORDER BY pos)),
h AS (SELECT t2.*, r0.valence AS valence, {rcols}
      FROM t2 JOIN roles r0 ON r0.w = t2.w AND r0.valence IS NOT NULL AND r0.incr IS NULL {joins}),
v0 AS (SELECT *, valence + CASE WHEN up AND cap_diff THEN {_signed('valence', CAPS_INCREMENT)} ELSE 0.0::DOUBLE END AS v FROM h),
{", ".join(steps)},
vb AS (SELECT doc_id, sid, pos,
       CASE WHEN but_at >= 0 AND pos < but_at THEN v * {dbl(BUT_BEFORE)}
            WHEN but_at >= 0 AND pos > but_at THEN v * {dbl(BUT_AFTER)} ELSE v END AS v FROM v3),
hs AS (SELECT doc_id, sid, {reduce('v', 'true')} AS s_raw, {reduce('v + 1.0::DOUBLE', 'v > 0')} AS pos_raw,
       {reduce('v - 1.0::DOUBLE', 'v < 0')} AS neg_raw, count(*) FILTER (WHERE v <> 0) AS nz
       FROM vb GROUP BY doc_id, sid),
ss AS (SELECT s3.doc_id, s3.sid, s3.n_tok, s3.punct, coalesce(hs.s_raw, 0.0::DOUBLE) AS s,
       coalesce(hs.pos_raw, 0.0::DOUBLE) AS ps, coalesce(hs.neg_raw, 0.0::DOUBLE) AS ns, coalesce(hs.nz, 0) AS nz
       FROM s3 LEFT JOIN hs ON s3.doc_id = hs.doc_id AND s3.sid = hs.sid),
e AS (SELECT doc_id, sid, n_tok,
       CASE WHEN s > 0 THEN s + punct WHEN s < 0 THEN s - punct ELSE s END AS se,
       CASE WHEN ps > abs(ns) THEN ps + punct ELSE ps END AS ps2,
       CASE WHEN ps < abs(ns) THEN ns - punct ELSE ns END AS ns2,
       CAST(n_tok AS DOUBLE) - CAST(nz AS DOUBLE) AS neu FROM ss),
sent_scores AS (SELECT doc_id, sid,
       CASE WHEN n_tok > 0 THEN round(se / sqrt(se * se + {alpha}), 4) + 0.0::DOUBLE ELSE 0.0::DOUBLE END AS compound,
       CASE WHEN n_tok > 0 THEN round(abs(ps2 / (ps2 + abs(ns2) + neu)), 3) + 0.0::DOUBLE ELSE 0.0::DOUBLE END AS pos,
       CASE WHEN n_tok > 0 THEN round(abs(neu / (ps2 + abs(ns2) + neu)), 3) + 0.0::DOUBLE ELSE 0.0::DOUBLE END AS neu,
       CASE WHEN n_tok > 0 THEN round(abs(ns2 / (ps2 + abs(ns2) + neu)), 3) + 0.0::DOUBLE ELSE 0.0::DOUBLE END AS neg
       FROM e),
doc_scores AS (SELECT doc_id, CAST(sum(CAST(round(compound * 10000) AS BIGINT)) AS DOUBLE)
       / (count(*) * 10000.0::DOUBLE) AS vader, CAST(count(*) AS BIGINT) AS n FROM sent_scores GROUP BY doc_id)"""


def _pair_score(a: str, b: str, ab: str, n: str) -> str:
    """Log-likelihood ratio from four counts, by hypothesis."""
    def terms(k, of, p):
        return f"(({k}) * ln({p}) + (({of}) - ({k})) * ln(1.0::DOUBLE - ({p})))"

    p, p1, p2 = f"({b}) / ({n})", f"({ab}) / ({a})", f"CASE WHEN ({n}) > ({a}) THEN (({b}) - ({ab})) / (({n}) - ({a})) ELSE 1.0::DOUBLE END"
    one = f"CASE WHEN ({a}) = ({ab}) OR {p1} <= 0 OR {p1} >= 1 THEN 0.0::DOUBLE ELSE {terms(ab, a, p1)} END"
    rest = (f"CASE WHEN ({b}) = ({ab}) OR ({p2}) <= 0 OR ({p2}) >= 1 THEN 0.0::DOUBLE "
            f"ELSE {terms(f'({b}) - ({ab})', f'({n}) - ({a})', p2)} END")
    return f"(-2.0::DOUBLE * ({terms(ab, a, p)} + {terms(f'({b}) - ({ab})', f'({n}) - ({a})', p)} - ({one}) - ({rest})))"


def learned_sentences_sql() -> str:
    """Counts, learnt sets and sentences, from the characters of the trimmed text."""
    def typ(w):
        return rf"regexp_replace({core(w)}, '\.+$', '')"

    def core(w):
        return rf"regexp_replace(regexp_replace(lower({w}), '^[^\p{{L}}\p{{N}}]+', ''), '[^\p{{L}}\p{{N}}.]+$', '')"

    def period(w):
        return rf"regexp_matches({core(w)}, '(^|[^.])\.$')"

    given = dbl(PERIOD_GIVEN_ABBREVIATION)
    return rf"""
WITH d AS (SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT unnest(list_filter(regexp_split_to_array(t, '\s+'), lambda x: x <> '')) AS w FROM d),
ty AS (SELECT typ, count_if(p)::DOUBLE AS nw, count_if(NOT p)::DOUBLE AS no
       FROM (SELECT {typ('w')} AS typ, {period('w')} AS p FROM w) WHERE typ <> '' GROUP BY typ),
tot AS (SELECT sum(nw) AS np, sum(nw + no) AS n FROM ty),
rate AS (SELECT n, least(greatest(np, 0.5::DOUBLE), n - 0.5::DOUBLE) / n AS p FROM tot),
ab AS (SELECT typ FROM (SELECT typ, no, inn, (length(typ) - inn)::DOUBLE AS letters,
         -2.0::DOUBLE * ((nw * ln(p) + no * ln(1.0::DOUBLE - p)) - (nw * ln({given}) + no * ln(1.0::DOUBLE - {given}))) AS r
         FROM (SELECT *, length(typ) - length(replace(typ, '.', '')) AS inn FROM ty) CROSS JOIN rate
         WHERE nw > 0 AND regexp_matches(typ, '\p{{L}}') AND NOT regexp_matches(typ, '\p{{N}}'))
       WHERE r * exp(-letters) * (inn + 1.0::DOUBLE) * pow(letters, -no) >= {dbl(ABBREVIATION_SCORE)}),
g AS (SELECT doc_id, list_filter(regexp_extract_all(t || ' ', '(?s)\s*(?:[^.!?]|[.!?]+[^\s.!?])*(?:[.!?]+|$)'), lambda x: regexp_matches(x, '\S')) AS s
      FROM d WHERE t <> ''),
h AS (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM g),
b AS (SELECT doc_id, i, s[i] AS seg, i = len(s) AS fin, regexp_extract(s[i], '(\S+)\s*$', 1) AS la,
      regexp_extract(coalesce(s[i + 1], ''), '^\s*(\S+)', 1) AS fi FROM h),
bt AS (SELECT doc_id, i, seg, fin, {typ('la')} AS x, {typ('fi')} AS y, {period('la')} AS p,
       regexp_matches(regexp_replace(fi, '^[^\p{{L}}\p{{N}}]+', ''), '^\p{{Lu}}') AS up FROM b),
pr AS (SELECT x, y, p, count(*)::DOUBLE AS n, p AND x IN (SELECT typ FROM ab) AS a FROM bt WHERE NOT fin GROUP BY x, y, p),
nb AS (SELECT sum(n) AS k FROM pr WHERE NOT a),
st AS (SELECT typ FROM (SELECT ty.typ, nw + no AS c, q.n AS k2, nb.k, rate.n AS n
         FROM (SELECT y, sum(n) AS n FROM pr WHERE NOT a GROUP BY y) q JOIN ty ON ty.typ = q.y CROSS JOIN nb CROSS JOIN rate)
       WHERE {_pair_score('k', 'c', 'k2', 'n')} >= {dbl(STARTER_SCORE)} AND n / k > c / k2 AND regexp_matches(typ, '^\p{{L}}')),
co AS (SELECT x, y FROM (SELECT x, y, q.n AS k2, s.nw + s.no AS ca, e.nw + e.no AS cb, rate.n AS n
         FROM pr q JOIN ty s ON s.typ = q.x JOIN ty e ON e.typ = q.y CROSS JOIN rate
         WHERE q.p AND (q.a OR regexp_matches(x, '^(\p{{L}}|[\p{{N}}.,-]*\p{{N}})$')) AND y NOT IN (SELECT typ FROM st))
       WHERE {_pair_score('ca', 'cb', 'k2', 'n')} >= {dbl(COLLOCATION_SCORE)} AND n / ca > cb / k2),
m AS (SELECT bt.*, NOT fin AND p AND (co.x IS NOT NULL OR (ab.typ IS NOT NULL AND NOT (up AND st.typ IS NOT NULL))) AS tied
      FROM bt LEFT JOIN ab ON ab.typ = bt.x LEFT JOIN st ON st.typ = bt.y LEFT JOIN co ON co.x = bt.x AND co.y = bt.y),
k AS (SELECT *, coalesce(sum(CASE WHEN tied THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0)::BIGINT AS sid FROM m)
SELECT doc_id, sid, regexp_replace(string_agg(seg, '' ORDER BY i), '^\s+|\s+$', '', 'g') AS sentence FROM k GROUP BY doc_id, sid"""


DOC_SOURCE = "docsrc AS (SELECT doc_id, text FROM documents)"
REVIEW_SOURCE = "revsrc AS (SELECT review_id AS doc_id, text FROM reviews)"


def _pred(classes: int) -> str:
    band = dbl(NEUTRAL_BAND)
    if classes == 3:
        lab = THREE_CLASS
        pred = (f"CAST(CASE WHEN vader >= {band} THEN 3 WHEN vader <= -{band} THEN 1 ELSE 2 END AS DOUBLE)")
    else:
        lab = BINARY
        pred = f"CAST(CASE WHEN vader >= {band} THEN 1 ELSE 0 END AS DOUBLE)"
    return (f"WITH {REVIEWS}, {REVIEW_SOURCE}{lexicon_ctes('revsrc')},\n"
            f"pred AS (SELECT {lab} AS label, {pred} AS prediction FROM reviews r JOIN doc_scores s "
            f"ON r.review_id = s.doc_id),\n"
            f"cm AS (SELECT label, prediction, CAST(count(*) AS BIGINT) AS n FROM pred GROUP BY label, prediction)\n")


def _r(expr: str) -> str:
    return f"round({expr}, {METRIC_DIGITS})"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0::DOUBLE END"


def paired_interval_sql() -> str:
    """The draws of a row are the thresholds of the Poisson(1) distribution function that it reaches."""
    reached = " + ".join(f"(u >= {cut})::BIGINT" for cut in draw_thresholds())
    cut = f"floor(len(g) * {dbl((1 - LEVEL) / 2)})::BIGINT"
    return f"""WITH {REVIEWS}, p AS (SELECT review_id, {BINARY} AS label, 1.0 AS a,
  CASE WHEN length(text) > {LONG_REVIEW} THEN 0.0 ELSE 1.0 END AS b FROM reviews),
f AS (SELECT review_id, (label = a)::BIGINT AS a, (label = b)::BIGINT AS b FROM p WHERE label IS NOT NULL),
d AS (SELECT replicate, a, b, ('0x' || substr(md5('{SPLIT_SEED}:' || replicate || ':' || review_id), 1, 7))::BIGINT AS u
  FROM f, (SELECT unnest(range(1, {REPLICATES + 1})) AS replicate)),
t AS (SELECT replicate, a, b, {reached} AS t FROM d),
r AS (SELECT (sum(t * b) - sum(t * a)) / sum(t) AS gain FROM t GROUP BY replicate HAVING sum(t) > 0),
g AS (SELECT list_sort(list(gain)) AS g FROM r),
w AS (SELECT count(*) AS total, sum(a) / count(*) AS accuracy_a, sum(b) / count(*) AS accuracy_b,
  (sum(b) - sum(a)) / count(*) AS gain FROM f)
SELECT total, {_r('accuracy_a')} AS accuracy_a, {_r('accuracy_b')} AS accuracy_b, {_r('gain')} AS gain,
  {_r(f'g[{cut} + 1]')} AS low, {_r(f'g[len(g) - {cut}]')} AS high FROM w, g"""


def oracle_sql() -> dict[str, str]:
    train_pct = int(round(SPLIT_WEIGHTS[0] * 100))
    bucket = (f"(CAST('0x' || substr(md5({lit(f'{SPLIT_SEED}:')} || review_id), 1, 8) AS BIGINT) % 100)")
    pat = lit(SCORE_LINE)
    q = "CAST(quality AS VARCHAR)"
    t = "CAST(toxic AS VARCHAR)"
    i = "CAST(doc_id AS VARCHAR)"
    line = (f"coalesce(CASE WHEN quality = 0 AND toxic = 1 THEN 'garbage ' || {i} "
            f"WHEN doc_id % 2 = 0 THEN '(''' || {i} || ''', ' || {q} || '.' || {t} || '5)' "
            f"ELSE '(u''' || {i} || ''', -' || {q} || '.' || {t} || '5e-02)' END, 'garbage')")
    quoted_line = ("CASE WHEN turn % 2 = 0 THEN '\"' || replace(text, '\"', '\"\"') || '\"' ELSE text END")
    unquoted = ("CASE WHEN line LIKE '\"%' AND line LIKE '%\"' AND length(line) >= 2 "
                "THEN replace(substr(line, 2, length(line) - 2), '\"\"', '\"') ELSE line END")
    acc = _ratio("sum(CASE WHEN label = prediction THEN n ELSE 0 END)", "sum(n)")
    weighted = """,
cls AS (SELECT cls, sum(actual) AS actual, sum(predicted) AS predicted, sum(tp) AS tp FROM (
          SELECT label AS cls, n AS actual, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM cm
          UNION ALL SELECT prediction, 0, n, 0 FROM cm) GROUP BY cls),
pc AS (SELECT actual, tp, {p} AS p, {r} AS r FROM cls WHERE actual > 0),
pf AS (SELECT actual, tp, p, r, CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * p * r / (p + r) END AS f1 FROM pc)
SELECT {acc} AS accuracy, {wp} AS weighted_precision, {wr} AS weighted_recall, {wf} AS weighted_f1,
       CAST(coalesce(sum(actual), 0) AS BIGINT) AS total FROM pf""".format(
        p=_ratio("tp", "predicted"), r=_ratio("tp", "actual"),
        acc=_r(_ratio("sum(tp)", "sum(actual)")), wp=_r(_ratio("sum(actual * p)", "sum(actual)")),
        wr=_r(_ratio("sum(actual * r)", "sum(actual)")), wf=_r(_ratio("sum(actual * f1)", "sum(actual)")))

    def cell(cond):
        return f"CAST(coalesce(sum(n) FILTER (WHERE {cond}), 0) AS BIGINT)"

    binary = (f"SELECT tp, tn, fp, fn, total, {_r(_ratio('tp', 'tp + fn'))} AS recall, "
              f"{_r(_ratio('tp', 'tp + fp'))} AS precision FROM (SELECT "
              f"{cell('label = 1.0 AND prediction = 1.0')} AS tp, "
              f"{cell('NOT (label = 1.0) AND NOT (prediction = 1.0)')} AS tn, "
              f"{cell('NOT (label = 1.0) AND prediction = 1.0')} AS fp, "
              f"{cell('label = 1.0 AND NOT (prediction = 1.0)')} AS fn, "
              f"CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM cm)")
    return {
        "scan_reviews_json": f"WITH {REVIEWS} SELECT * FROM reviews",
        "parse_score_lines": (f"WITH lines AS (SELECT {line} AS value FROM labels) "
                              f"SELECT nullif(regexp_extract(value, {pat}, 1), '') AS review_id, "
                              f"TRY_CAST(regexp_extract(value, {pat}, 2) AS DOUBLE) AS vader FROM lines"),
        "scores_roundtrip": (f"WITH {REVIEWS}, {REVIEW_SOURCE}{lexicon_ctes('revsrc')} "
                             f"SELECT doc_id AS review_id, vader, n FROM doc_scores"),
        "project_reviews": f"WITH {REVIEWS} SELECT review_id, text, stars FROM reviews",
        "unquote_lines": (f"SELECT conv_id, turn, {unquoted} AS review FROM "
                          f"(SELECT conv_id, turn, {quoted_line} AS line FROM conversations)"),
        "drop_header": (f"SELECT conv_id, turn, text AS value FROM conversations "
                        f"WHERE text IS DISTINCT FROM {lit(HEADER)}"),
        "drop_first_lines": ("SELECT CASE WHEN turn < 3 THEN 'lines' || (turn % 3) ELSE conv_id || ':' || turn || ':' || "
                             "translate(coalesce(text, ''), chr(10) || chr(13), '  ') END AS value FROM conversations"),
        "label_three_class": f"WITH {REVIEWS} SELECT review_id, stars, {THREE_CLASS} AS label FROM reviews",
        "label_binary": f"WITH {REVIEWS} SELECT review_id, stars, {BINARY} AS label FROM reviews",
        "label_raw": f"WITH {REVIEWS} SELECT review_id, stars, stars AS label FROM reviews",
        "join_scores": (f"WITH {REVIEWS}, {DOC_SOURCE}{lexicon_ctes('docsrc')} "
                        f"SELECT r.review_id, r.text, r.stars, s.vader FROM reviews r "
                        f"JOIN doc_scores s ON r.review_id = CAST(s.doc_id AS VARCHAR)"),
        "split_by_key": (f"WITH {REVIEWS} SELECT review_id, CASE WHEN {bucket} < {train_pct} "
                         f"THEN 'train' ELSE 'test' END AS part FROM reviews"),
        "split_exact": (f"WITH {REVIEWS}, k AS (SELECT review_id, row_number() OVER (ORDER BY "
                        f"substr(md5('{SPLIT_SEED}:' || review_id), 1, 15), review_id) AS place, count(*) OVER () AS n "
                        f"FROM (SELECT DISTINCT review_id FROM reviews)) "
                        f"SELECT r.review_id, CASE WHEN k.place <= (k.n * {train_pct} + 50) // 100 THEN 'train' ELSE 'test' END "
                        f"AS part FROM reviews r JOIN k ON r.review_id = k.review_id"),
        "tokenize": exploded("documents", tokens()),
        "stop_words_default": exploded("documents", without(tokens(), default_stop_words("english"))),
        "stop_words_custom": exploded("documents", without(tokens(), NLTK_ENGLISH_STOP_WORDS)),
        "hashed_tf_totals": f"WITH {KEPT} SELECT doc_id, CAST(len(a) AS BIGINT) AS n_terms FROM kept",
        "term_frequency": f"WITH {KEPT}, {TF} SELECT doc_id, term, tf FROM tf",
        "document_frequency": f"WITH {KEPT}, {DF} SELECT term, df FROM dfreq",
        "inverse_document_frequency": (f"WITH {KEPT}, {DF}, {IDF} "
                                       f"SELECT term, df, round(idf, 6) AS idf FROM idf"),
        "tfidf_terms": (f"WITH {KEPT}, {TF}, {DF}, {IDF} SELECT tf.doc_id, tf.term, tf.tf, "
                        f"round(CAST(tf.tf AS DOUBLE) * idf.idf, 6) AS tfidf FROM tf JOIN idf ON tf.term = idf.term"),
        "sentences_exploded": exploded("documents", sentences(), "sid", "sentence"),
        "lexicon_sentence": (f"WITH {DOC_SOURCE}{lexicon_ctes('docsrc')} "
                             f"SELECT doc_id, sid, compound, pos, neu, neg FROM sent_scores"),
        "sentences_learned": learned_sentences_sql(),
        "lexicon_phrases": (f"WITH {DOC_SOURCE}{lexicon_ctes('docsrc', FIXTURE_PHRASES)} "
                            "SELECT doc_id, sid, compound, pos, neu, neg FROM sent_scores"),
        "lexicon_doc_mean": f"WITH {DOC_SOURCE}{lexicon_ctes('docsrc')} SELECT doc_id, vader, n FROM doc_scores",
        "metrics_micro": (_pred(3) + f"SELECT {_r(acc)} AS accuracy, {_r(acc)} AS precision, "
                          f"{_r(acc)} AS recall, {_r(acc)} AS f1, "
                          f"CAST(coalesce(sum(n), 0) AS BIGINT) AS total FROM cm"),
        "metrics_weighted": _pred(3).rstrip("\n") + weighted,
        "confusion_matrix": _pred(3) + "SELECT label, prediction, n FROM cm",
        "binary_counts": _pred(2) + binary,
        "paired_interval": paired_interval_sql(),
    }
