"""I and J: generation requests, acceptance, splitting, training pairs."""
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import prompts as pr
from ..functions.arrays import chunk_sequential, negatives_for
from ..functions.payloads import extract_json
from ..operators import generation as op, pairs, stats
from ..operators.balance import negative_pool_size
from ..operators.similarity import group_hard_negatives
from ..plans.compress import compress_or_split
from ..plans.new_labels import new_label_samples
from ..session import cut_lineage, scratch_dir
from ..sources import tables as t
from .base import joined, query
from .relations import occupation_lists
from .stats import FREQ, freq
from .views import sql, words

W = words("text")
TOK = f"CAST(floor({W} * 1.3) AS BIGINT)"
BLANK = r"[\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]"


def chunked(c):
    return F.array_join(F.transform(c, lambda g: F.array_join(g, "|")), " / ")


@query("i1_token_count", f"SELECT doc_id, {TOK} AS tokens, least({TOK}, 512) AS cut FROM documents")
def i1(spark, d):
    return t.v_text(spark, d).select("doc_id", tx.token_count(F.col("query")).alias("tokens"), tx.token_count(F.col("query"), max_length=512).alias("cut"))


@query("i1_token_count_tokenizer", f"SELECT doc_id, {W} + 2 AS tokens FROM documents")
def i1b(spark, d):
    return t.v_text(spark, d).select("doc_id", tx.token_count(F.col("query"), lambda x: len(x.split()) + 2).alias("tokens"))


ROUTE = f"""CASE WHEN {TOK} <= 320 THEN 'keep' WHEN p > 3 OR ({TOK} >= 700 AND p > 1) OR p > 5 THEN 'split' ELSE 'compress' END"""


@query("i2_route", f"SELECT doc_id, {ROUTE} AS route FROM (SELECT doc_id, text, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 4 END AS p FROM documents)")
def i2(spark, d):
    p = F.when(F.col("lang") == "en", 1).when(F.col("lang") == "fr", 2).otherwise(4)
    return t.v_text(spark, d).select("doc_id", tx.route(tx.token_count(F.col("query")), p).alias("route"))


@query("i3_chunk_sequential", sql("""SELECT v_sample.sample_id, coalesce(chunks, '') AS chunks FROM v_sample LEFT JOIN (SELECT sample_id, string_agg(c, ' / ' ORDER BY i) AS chunks FROM (SELECT sample_id, (p - 1) // 3 AS i, string_agg(l, '|' ORDER BY p) AS c FROM
    (SELECT sample_id, unnest(pos) AS l, generate_subscripts(pos, 1) AS p FROM v_sample) GROUP BY ALL) GROUP BY 1) x ON x.sample_id = v_sample.sample_id""", "v_sample"))
def i3(spark, d):
    return t.v_sample(spark, d).select("sample_id", chunked(chunk_sequential(F.col("pos"), 3)).alias("chunks"))


def grouped(spark, d):
    """Answers in a fence that name every second label first, the rest is forgotten; urgent orders get no JSON."""
    s = t.v_sample(spark, d).where(F.size("pos") > 0)
    named = F.array_distinct(F.filter("pos", lambda l: l < "n"))
    answer = F.concat(F.lit('Sure:\n```json\n{"groups": [{"labels": '), F.to_json(F.slice(named, 1, 2)), F.lit('}, {"x": 1}, {"labels": '),
                      F.to_json(F.concat(F.array(F.lit("unknown"), F.lit(" ")), named)), F.lit("}]}\n```\nDone."))
    answer = F.when(F.col("query").startswith("1"), "no groups").otherwise(answer)
    return s.withColumn("answer", answer).withColumn("groups", op.reconcile_groups(F.col("pos"), F.col("answer"), 2))


GROUPED = """SELECT *, CASE WHEN len(pos) <= 2 THEN [pos] WHEN left(query, 1) = '1' THEN NULL WHEN len(rest) = 0 THEN once
    WHEN len(once) > 0 AND len(once[-1]) + len(rest) <= 2 THEN list_concat(once[1:-2], [list_concat(once[-1], rest)])
    ELSE list_concat(once, list_transform(range(0, CAST(ceil(len(rest) / 2) AS BIGINT)), lambda i: rest[i*2+1:i*2+2])) END AS groups FROM (
    SELECT *, list_filter(pos, lambda x: NOT list_contains(named, x)) AS rest, list_filter([named[1:2], named[3:]], lambda g: len(g) > 0) AS once FROM (
    SELECT sample_id, query, pos, neg, list_filter(list_filter(pos, lambda x, i: list_position(pos, x) = i), lambda x: x < 'n') AS named FROM v_sample WHERE len(pos) > 0))"""


@query("i4_reconcile_groups", sql("SELECT sample_id, array_to_string(list_transform(groups, lambda g: array_to_string(g, '|')), ' / ') AS groups FROM gr", "v_sample", gr=GROUPED))
def i4(spark, d):
    return grouped(spark, d).select("sample_id", chunked(F.col("groups")).alias("groups"))


@query("i5_split_by_group", sql("""SELECT sample_id, array_to_string(list_filter(g, lambda x, k: list_position(g, x) = k), '|') AS pos,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(neg, list_filter(flatten(groups), lambda x: NOT list_contains(g, x))))), '|'), '') AS neg,
    i - 1 AS group_index, len(list_distinct(g)) AS group_size, len(groups) AS total_groups
    FROM (SELECT *, unnest(groups) AS g, generate_subscripts(groups, 1) AS i FROM gr WHERE groups IS NOT NULL) WHERE len(g) > 0""", "v_sample", gr=GROUPED))
def i5(spark, d):
    x = op.split_by_group(grouped(spark, d))
    return x.select("sample_id", joined("pos"), joined("neg"), "group_index", "group_size", "total_groups")


@query("i6_compress_result", sql("""SELECT sample_id, CASE WHEN left(query, 1) IN ('1', '2') THEN query ELSE rtrim('[DryRun] komprimiert: ' || array_to_string(pos, ', ')) END AS query, array_to_string(pos, '|') AS pos,
    CASE WHEN left(query, 1) NOT IN ('1', '2') THEN 'compress' END AS augmentation, CASE WHEN left(query, 1) IN ('1', '2') THEN 'empty answer' END AS error FROM v_sample""", "v_sample"))
def i6(spark, d):
    """Some answers are missing, some blank."""
    s = t.v_sample(spark, d)
    blank = F.when(F.col("query").startswith("2"), F.lit(" ")).otherwise(op.dry_run_compress(F.col("pos")))
    good, failed = op.compress_result(s, s.where("query not like '1%'").select("sample_id", blank.alias("text")))
    return good.select("sample_id", "query", joined("pos"), "augmentation").unionByName(failed.select("sample_id", "query", joined("pos"), "error"), allowMissingColumns=True)


@query("i6_compress_or_split", f"""WITH x AS (SELECT doc_id, text, lang, {TOK} AS n, CASE lang WHEN 'en' THEN 1 WHEN 'fr' THEN 2 ELSE 4 END AS p FROM documents),
    r AS (SELECT *, list_transform(range(1, p + 1), lambda i: 'label ' || i) AS pos, {ROUTE} AS route FROM x)
    SELECT doc_id AS sample_id, 'keep' AS strategy, NULL::BIGINT AS group_index, md5(text) AS query_md5, array_to_string(pos, '|') AS pos, lang AS neg, n AS original_tokens FROM r WHERE route = 'keep' UNION ALL
    SELECT doc_id, 'compress', NULL, md5('[DryRun] komprimiert: ' || array_to_string(pos, ', ')), array_to_string(pos, '|'), lang, n FROM r WHERE route = 'compress' UNION ALL
    SELECT doc_id, 'label_group', g, md5('[DryRun] Kurztext für ' || array_to_string(pos[3 * g + 1:3 * g + 3], ', ')), array_to_string(pos[3 * g + 1:3 * g + 3], '|'),
        array_to_string(list_sort(list_concat([lang], list_filter(pos, lambda l, i: (i - 1) // 3 <> g))), '|'), n FROM r, (SELECT unnest([0, 1]) AS g) WHERE route = 'split' AND 3 * g < p""".replace("p > 5", "p > 3"))
def i6_compress_or_split(spark, d):
    """Dry run over all documents: kept, split in consecutive groups, or compressed."""
    p = F.when(F.col("lang") == "en", 1).when(F.col("lang") == "fr", 2).otherwise(4)
    s = t.v_text(spark, d).select(F.col("doc_id").alias("sample_id"), "query", F.transform(F.sequence(F.lit(1), p), lambda i: F.concat(F.lit("label "), i.cast("string"))).alias("pos"), F.array("lang").alias("neg"))
    made, failed = compress_or_split(s, n=3)
    both = made.unionByName(failed, allowMissingColumns=True)
    return both.select("sample_id", "strategy", "group_index", F.md5("query").alias("query_md5"), joined("pos"), joined("neg"), "original_tokens")


def _lit(s):
    return "'" + s.replace("'", "''") + "'"


NL = "chr(10)"
SORTED = "coalesce(nullif(array_to_string(list_sort(list_distinct({c})), ', '), ''), '(keine)')"


@query("i7_compress_prompt", sql("SELECT sample_id, md5('Kompetenzen: ' || " + SORTED.format(c="pos") + f" || {_lit(chr(10) + pr.TASK + chr(10) + chr(10).join(pr.COMPRESS) + chr(10) + pr.ORIGINAL + chr(10))} || query) AS digest FROM v_sample", "v_sample"))
def i7(spark, d):
    return t.v_sample(spark, d).select("sample_id", F.md5(pr.compress_prompt(F.col("query"), F.col("pos"))).alias("digest"))


@query("i7_cluster_prompt", sql(f"""SELECT sample_id, md5({_lit('Zu gruppierende Kompetenzen:' + chr(10))} || array_to_string(list_transform(pos, lambda x: '- ' || x), {NL}) ||
    {_lit(chr(10) + pr.TASK + chr(10) + chr(10).join(pr.CLUSTER).replace('{n}', '3'))}) AS digest FROM v_sample""", "v_sample"))
def i7b(spark, d):
    return t.v_sample(spark, d).select("sample_id", F.md5(pr.cluster_prompt(F.col("pos"), 3)).alias("digest"))


@query("i7_group_prompt", sql(f"""SELECT sample_id, md5('Fokus-Kompetenzen: ' || {SORTED.format(c='pos')} || {NL} || 'Zu vermeidende Kompetenzen: ' || {SORTED.format(c='neg')} ||
    {_lit(chr(10) + pr.TASK + chr(10) + pr.GROUP_FIRST + chr(10) + pr.GROUP_FOCUS[0])} || {SORTED.format(c='pos')} || {_lit('.' + chr(10) + chr(10).join(pr.GROUP_MIDDLE) + chr(10))} ||
    CASE WHEN len(neg) > 0 THEN {_lit(pr.GROUP_AVOID[0])} || {SORTED.format(c='neg')} || '.' || {NL} ELSE '' END || {_lit(pr.GROUP_LAST + chr(10) + pr.ORIGINAL + chr(10))} || query) AS digest FROM v_sample""", "v_sample"))
def i7c(spark, d):
    return t.v_sample(spark, d).select("sample_id", F.md5(pr.group_prompt(F.col("query"), F.col("pos"), F.col("neg"))).alias("digest"))


def _prompt_rows(spark, d):
    """Label documents as requests: the label is the focus, its first occupation the term to avoid."""
    x = t.v_doc(spark, d)
    return x.withColumn("avoid", F.slice("occupations", 1, 1)).withColumn("scenario", F.when(F.length("label") > 18, "Kursinhalte").otherwise("Lernergebnis"))


THREE = """CASE WHEN len(occupations) = 0 THEN '(keine Angaben)' WHEN len(occupations) <= 3 THEN array_to_string(occupations, ', ') ELSE
    (SELECT string_agg(o, ', ' ORDER BY md5('42|' || label || '|' || o)) FROM (SELECT o FROM (SELECT unnest(occupations) AS o) ORDER BY md5('42|' || label || '|' || o) LIMIT 3)) END"""
GUIDE = f"CASE WHEN length(label) > 18 THEN {_lit(chr(10).join(pr.GUIDANCE['Kursinhalte']))} ELSE {_lit(chr(10).join(pr.GUIDANCE['Lernergebnis']))} END"
SCEN = "CASE WHEN length(label) > 18 THEN 'Kursinhalte' ELSE 'Lernergebnis' END"


@query("i7_rare_prompt", sql(f"""SELECT label, md5({_lit(pr.ESCO + chr(10))} || description || {_lit(chr(10) + pr.JOBS + chr(10))} || {THREE} ||
    {_lit(chr(10) + pr.TASK + chr(10) + pr.ONE_TEXT.replace('{n}', '300') + chr(10) + pr.RARE_FOCUS[0])} || label || {_lit(pr.RARE_FOCUS[1] + chr(10) + pr.RARE_STYLE[0])} || {SCEN} ||
    {_lit(pr.RARE_STYLE[1] + chr(10) + chr(10).join(pr.RARE_FIXED) + chr(10))} || {GUIDE} || {_lit(chr(10) + chr(10).join(pr.LAST))} ||
    CASE WHEN len(occupations) > 0 THEN {_lit(chr(10) + pr.RARE_AVOID[0])} || occupations[1] || '.' ELSE '' END) AS digest FROM v_doc""", "v_doc"))
def i7d(spark, d):
    x = _prompt_rows(spark, d)
    p = pr.rare_prompt(F.col("description"), F.col("occupations"), F.array("label"), F.col("scenario"), F.col("avoid"), 400, F.col("label"))
    return x.select("label", F.md5(p).alias("digest"))


@query("i7_new_skill_prompt", sql(f"""SELECT label, md5({_lit(pr.NEW_MANY[0] + chr(10) + pr.SKILLS)} || label || ' und x' || {_lit(chr(10) + pr.ESCO + chr(10))} || description || {_lit(chr(10) + pr.JOBS + chr(10))} || {THREE} ||
    {_lit(chr(10) + pr.TASK + chr(10) + pr.ONE_TEXT.replace('{n}', '150') + chr(10) + pr.NEW_MANY[1])} || label || ' und x.' || {_lit(chr(10) + pr.NEW_STYLE[0])} || {SCEN} ||
    {_lit(pr.NEW_STYLE[1] + chr(10) + chr(10).join(pr.NEW_FIXED) + chr(10) + pr.NEW_TOGETHER + chr(10))} || {GUIDE} || {_lit(chr(10) + chr(10).join(pr.LAST))} ||
    CASE WHEN len(occupations) > 0 THEN {_lit(chr(10) + pr.NEW_AVOID[0])} || occupations[1] || '.' ELSE '' END) AS digest FROM v_doc""", "v_doc"))
def i7e(spark, d):
    x = _prompt_rows(spark, d)
    p = pr.new_skill_prompt(F.col("description"), F.col("occupations"), F.array(F.col("label"), F.lit("x")), F.col("scenario"), F.col("avoid"), 200, F.col("label"))
    return x.select("label", F.md5(p).alias("digest"))


@query("i8_generate_dry_run", sql("SELECT label, '[DryRun] Beispieltext 1 zu ' || label AS text, 'ok' AS status FROM v_skill", "v_skill"))
def i8(spark, d):
    x = t.v_skill(spark, d).select("label", F.col("label").alias("prompt"))
    return op.generate(x, dry_text=op.dry_run_text(F.col("label"))).select("label", "text", "status")


@query("i8_generate_stored", sql("""SELECT label, CASE WHEN NOT contains(label, 'gizmo') THEN upper(label) END AS text, CASE WHEN contains(label, 'gizmo') THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN contains(label, 'gizmo') THEN 'RuntimeError: refused' END AS error FROM v_skill""", "v_skill"))
def i8c(spark, d):
    """Asked in two calls: the first for some requests only, whose answers the second finds in the store."""
    def backend():
        def ask(prompt):
            if "gizmo" in prompt:
                raise RuntimeError("refused")
            return prompt.upper()
        return ask
    x, path = t.v_skill(spark, d).select("label", F.col("label").alias("prompt"), "size"), scratch_dir(spark)
    op.generate_stored(x.where("size > 25"), backend, path, "label", rounds=2, delay=0.0)
    return op.generate_stored(x, backend, path, "label", rounds=3, delay=0.0).select("label", "text", "status", "error")


@query("i8_generate_backend", sql("""SELECT label, CASE WHEN NOT contains(label, 'gizmo') THEN upper(label) END AS text, CASE WHEN contains(label, 'gizmo') THEN 'failed' ELSE 'ok' END AS status FROM v_skill""", "v_skill"))
def i8b(spark, d):
    """A backend callable that refuses some prompts for good and others once."""
    def backend():
        seen = set()

        def ask(prompt):
            if "gizmo" in prompt or ("ring" in prompt and prompt not in seen):
                seen.add(prompt)
                raise RuntimeError("refused")
            return prompt.upper()
        return ask
    x = t.v_skill(spark, d).select("label", F.col("label").alias("prompt"))
    return op.generate(x, backend, delay=0.0).select("label", "text", "status")


@query("i9_extract_bullets", sql(f"""SELECT conv_id, turn, string_agg(b, ' / ' ORDER BY i) AS bullets FROM (SELECT conv_id, turn, i,
    regexp_replace(regexp_replace(l, '^{BLANK}+|{BLANK}+$', '', 'g'), '^[\\-•*0-9. ]+', '') AS b FROM (SELECT conv_id, turn, unnest(string_split('- ' || replace(text, '. ', '.' || chr(10) || '2. '), chr(10))) AS l,
    generate_subscripts(string_split('- ' || replace(text, '. ', '.' || chr(10) || '2. '), chr(10)), 1) AS i FROM v_response)) WHERE b <> '' GROUP BY ALL""", "v_response"))
def i9(spark, d):
    marked = F.concat(F.lit("- "), F.regexp_replace("text", r"\. ", ".\n2. "))
    return t.v_response(spark, d).select("conv_id", "turn", F.array_join(tx.bullets(marked), " / ").alias("bullets"))


@query("i10_extract_json", "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE props END AS found FROM events")
def i10(spark, d):
    e = t.table(spark, d, "events").select("event_id", "event_type", "props")
    kind = F.col("event_type")
    wrapped = (F.when(kind == "click", F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nok")))
               .when(kind == "view", F.concat(F.lit("```"), "props", F.lit("```"))).when(kind == "error", F.concat(F.lit("no { json "), F.col("event_id").cast("string")))
               .when(kind == "purchase", F.concat(F.lit("text `"), "props", F.lit("` more"))).otherwise(F.concat(F.lit("so: "), "props", F.lit(" end"))))
    return e.select("event_id", extract_json(wrapped).alias("found"))


LEADS = """CASE WHEN starts_with({c}, 'Teilnehmende lernen in diesem Kurs:') THEN ltrim(substr({c}, 36)) WHEN starts_with({c}, 'Suche nach:') THEN ltrim(substr({c}, 12)) ELSE {c} END"""


@query("i11_strip_prefix", sql("""SELECT conv_id, turn, md5(CASE WHEN turn = 1 THEN ltrim(text, ' ') ELSE text END) AS digest FROM v_response""", "v_response"))
def i11(spark, d):
    x = F.when(F.col("turn") == 1, F.concat(F.lit("Suche nach:  "), "text")).otherwise(F.col("text"))
    return t.v_response(spark, d).select("conv_id", "turn", F.md5(tx.strip_lead_in(x)).alias("digest"))


CANDS = """SELECT doc_id, trim(text) AS base, length(trim(text)) AS n, source FROM documents"""
CUTS = """SELECT *, CASE WHEN n <= 400 THEN base WHEN length(bare) >= 240 AND length(dotted) <= 400 THEN dotted END AS cut FROM (SELECT *, CASE WHEN ends_with(bare, '.') THEN bare ELSE bare || '.' END AS dotted FROM (
    SELECT *, regexp_replace(CASE WHEN contains(head, ' ') THEN regexp_replace(head, ' [^ ]*$', '') ELSE head END, '[,;:\\-]+$', '') AS bare FROM (
    SELECT *, regexp_replace(substr(base, 1, 400), '{B}+$', '') AS head FROM (SELECT doc_id, regexp_replace(text, '^{B}+|{B}+$', '', 'g') AS base, source, length(regexp_replace(text, '^{B}+|{B}+$', '', 'g')) AS n FROM documents))))""".replace("{B}", BLANK)
JUDGED = """SELECT *, CASE WHEN base = '' THEN 'blank' WHEN cut IS NULL THEN 'too long' WHEN contains(lower(cut), 'xx') OR (source = 'src1' AND contains(lower(cut), 'the')) THEN 'forbidden term'
    WHEN md5(lower(cut)) IN (SELECT md5(lower(query)) FROM v_real) THEN 'existing text' END AS r FROM cuts"""
FINAL = """SELECT *, reason IS NULL AND row_number() OVER (PARTITION BY doc_id // 8, reason IS NULL ORDER BY doc_id) = 1 AS first_survivor FROM (
    SELECT *, coalesce(r, CASE WHEN row_number() OVER (PARTITION BY doc_id // 8, r IS NULL, lower(cut) ORDER BY doc_id) > 1 THEN 'repeated text' END) AS reason FROM judged)"""


@query("i12_accept", sql("SELECT doc_id // 8 AS request_id, doc_id % 8 AS cand_no, CASE WHEN reason IS NULL THEN md5(cut) END AS digest, reason AS reject_reason, first_survivor FROM final", "v_real", cuts=CUTS, judged=JUDGED, final=FINAL))
def i12(spark, d):
    x = t.v_text(spark, d).select(
        F.floor(F.col("doc_id") / 8).alias("request_id"), (F.col("doc_id") % 8).alias("cand_no"), F.col("query").alias("text"),
        F.when(F.col("source") == "src1", F.array(F.lit("THE"), F.lit("xx"))).otherwise(F.array(F.lit("xx"), F.lit(""))).alias("forbidden"))
    out = op.accept(x, 400, t.v_real(spark, d).select(F.col("query").alias("text")))
    return out.select("request_id", "cand_no", F.md5("accepted").alias("digest"), "reject_reason", "first_survivor")


@query("i13_forbidden_mentions", sql("SELECT conv_id, turn, contains(lower(text), 'der') OR contains(lower(text), 'les') AS warned FROM v_response", "v_response"))
def i13(spark, d):
    return t.v_response(spark, d).select("conv_id", "turn", op.forbidden_mentions(F.col("text"), F.array(F.lit("Der"), F.lit("LES"), F.lit(""))).alias("warned"))


FOCUS = dict(fr=FREQ, df="SELECT label FROM fr WHERE n < 25",
    oc="SELECT sample_id, list_filter(pos, lambda x, i: list_position(pos, x) = i) AS g, neg FROM v_sample WHERE len(pos) > 0",
    la="SELECT sample_id, list(l) AS lacking FROM (SELECT sample_id, unnest(g) AS l FROM oc) WHERE l IN (SELECT label FROM df) GROUP BY 1",
    be="""SELECT * FROM (SELECT label, oc.sample_id, g, neg, lacking, row_number() OVER (PARTITION BY label ORDER BY len(lacking) DESC, len(g) DESC, oc.sample_id) AS r
        FROM df JOIN (SELECT sample_id, unnest(lacking) AS label FROM la) x USING (label) JOIN la ON la.sample_id = x.sample_id JOIN oc ON oc.sample_id = x.sample_id) WHERE r = 1""",
    ot="SELECT *, (SELECT list(o ORDER BY md5('42|' || label || '|' || o)) FROM (SELECT unnest(lacking) AS o) WHERE o <> label) AS o FROM be",
    fo="""SELECT *, CASE WHEN o IS NULL THEN [label] ELSE list_concat([label], o[1:CASE WHEN least(len(o), 2) > 1 THEN 1 + CAST(floor((('0x' || substr(md5('42|' || label), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE * 2) AS BIGINT) ELSE 1 END]) END AS focus FROM ot""")


def deficits(spark, d):
    return stats.rare_labels(freq(spark, d), 25)


def focused(spark, d):
    return op.focus_labels(t.v_sample(spark, d), deficits(spark, d), 3)


@query("i14_focus_labels", sql("SELECT label, sample_id, array_to_string(g, '|') AS group_labels, array_to_string(focus, '|') AS focus FROM fo", "v_sample", **FOCUS))
def i14(spark, d):
    return focused(spark, d).select("label", "sample_id", joined("group_labels"), joined("focus"))


NEGS = "list_filter(list_concat(list_filter(g, lambda x: NOT list_contains(focus, x)), neg), lambda x: NOT list_contains(focus, x))"


@query("i15_negatives_for", sql(f"SELECT label, coalesce(array_to_string(list_filter(n, lambda x, i: list_position(n, x) = i)[1:4], '|'), '') AS negatives FROM (SELECT label, {NEGS} AS n FROM fo)", "v_sample", **FOCUS))
def i15(spark, d):
    unused = F.array_except("group_labels", "focus")
    return focused(spark, d).select("label", joined(negatives_for(unused, F.col("neg"), F.col("focus"), 4), "negatives"))


@query("i16_fill_deficits", "SELECT 0::BIGINT AS still_lacking, 0::BIGINT AS too_many, true AS all_distinct")
def i16(spark, d):
    """Dry run: after the rounds every label has its minimum, and none was given more than it lacked."""
    s = t.v_sample(spark, d)
    before = stats.label_frequency(s)
    f = op.fill_deficits(s, t.v_doc(spark, d), 12)
    gained = f.samples.select(F.explode("pos").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("g"))
    x = before.join(gained, "label", "full").select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("g", F.lit(0)).alias("g"))
    lack = x.agg(F.sum(F.greatest(F.lit(0), 12 - F.col("n") - F.col("g"))).cast("long").alias("still_lacking"), F.sum(F.when(F.col("g") > 0, F.greatest(F.lit(0), F.col("n") + F.col("g") - 12)).otherwise(0)).cast("long").alias("too_many"))
    same = f.samples.agg((F.count("query") == F.count_distinct("query")).alias("all_distinct"))
    return lack.withColumn("all_distinct", same.scalar())


@query("i17_new_label_requests", sql("""SELECT label AS target, sample_no, label AS focus, 'llm_new_skill' AS source, label || ': ' || description AS description, array_to_string(occupations, '|') AS occupations
    FROM v_doc, (SELECT unnest([0, 1]) AS sample_no) WHERE label NOT IN (SELECT label FROM v_item WHERE p_size > 30)""", "v_doc", "v_item"))
def i17(spark, d):
    docs = t.v_doc(spark, d)
    targets = docs.select("label").join(t.v_item(spark, d).where("p_size > 30").select("label").distinct(), "label", "left_anti")
    x = op.new_label_requests(targets, docs, per_label=2)
    return x.select("target", "sample_no", joined("focus"), "source", "description", joined("occupations"))


@query("i17_new_label_requests_multi")
def i17b(spark, d):
    """The label documents are kept once: companions, negatives and requests would else each build all lists of occupations again."""
    docs = cut_lineage(t.v_doc(spark, d))
    lists = docs.select("label", "occupations")
    from ..operators.similarity import cooccurring_by_group
    pool = group_hard_negatives(lists.select(F.col("label").alias("target_id"), F.array("label").alias("positives")), lists, lists.where("label < 'm'"), negative_pool_size(2))
    x = op.new_label_requests(docs.select("label"), docs, 2, cooccurring_by_group(lists, lists), pool.withColumnRenamed("target_id", "target"))
    return x.select("target", "sample_no", joined("focus"), joined("negatives"), "source", "scenario", "hint")


@query("i17_new_label_samples", sql("""SELECT label, sample_no, '[DryRun] Beispieltext ' || (sample_no + 1) || ' zu ' || label AS query, label AS pos, '' AS neg, 'llm_new_skill' AS source
    FROM v_doc, (SELECT unnest([0, 1]) AS sample_no) WHERE label NOT IN (SELECT label FROM v_item WHERE p_size > 30)""", "v_doc", "v_item"))
def i17_samples(spark, d):
    """The job in dry run: requests, answers, acceptance, records."""
    docs = t.v_doc(spark, d)
    targets = docs.select("label").join(t.v_item(spark, d).where("p_size > 30").select("label").distinct(), "label", "left_anti")
    records, _ = new_label_samples(targets, docs, per_label=2)
    return records.select("label", "sample_no", "query", joined("pos"), joined("neg"), "source")


@query("i18_synthetic_record", sql("SELECT label, label AS query, label AS pos, 'llm' AS source, 'Kursinhalte' AS scenario FROM v_skill", "v_skill"))
def i18(spark, d):
    rec = op.synthetic_record(F.col("label"), F.array("label"), F.expr("cast(array() as array<string>)"), F.lit(op.SOURCE_RARE), F.col("label"), F.lit("Kursinhalte"))
    return t.v_skill(spark, d).select("label", rec.alias("r")).select("label", "r.query", joined(F.col("r.pos"), "pos"), "r.meta.source", "r.meta.scenario")


@query("i19_prompt_log", sql("SELECT label, 2 AS n FROM v_skill", "v_skill"))
def i19(spark, d):
    from ..session import scratch_dir
    path = scratch_dir(spark)
    rows = t.v_skill(spark, d).select("label", F.array("label").alias("focus"), F.col("label").alias("prompt"))
    op.prompt_log(rows, path)
    op.prompt_log(rows, path)
    return spark.read.parquet(path).groupBy("label").agg(F.count("logged_at").alias("n"))


@query("i20_label_context", sql("""SELECT request_id, string_agg(description, ' ' ORDER BY i) AS description FROM (SELECT label AS request_id, unnest(focus) AS l, generate_subscripts(focus, 1) AS i FROM fo) x
    LEFT JOIN v_doc ON v_doc.label = x.l GROUP BY 1""", "v_sample", "v_doc", **FOCUS))
def i20(spark, d):
    r = focused(spark, d).select(F.col("label").alias("request_id"), "focus")
    return op.label_context(r, t.v_sample(spark, d), t.v_doc(spark, d))[0].select("request_id", "description")


@query("i20_label_context_queries", sql("""SELECT DISTINCT f.request_id, s.query FROM (SELECT label AS request_id, unnest(focus) AS l FROM fo) f JOIN (SELECT query, unnest(pos) AS l FROM v_sample) s ON f.l = s.l""", "v_sample", **FOCUS))
def i20b(spark, d):
    r = focused(spark, d).select(F.col("label").alias("request_id"), "focus")
    return op.label_context(r, t.v_sample(spark, d), t.v_doc(spark, d))[1]


# --- J ----------------------------------------------------------------------------------------------

@query("j1_training_pairs", sql("""SELECT sample_id, i - 1 AS pos_no, 'query: ' || query AS anchor, 'passage: ' || p AS positive, coalesce(array_to_string(list_transform(n, lambda x: 'passage: ' || x), '|'), '') AS negatives FROM (
    SELECT sample_id, query, unnest(pos) AS p, generate_subscripts(pos, 1) AS i, (SELECT list(l ORDER BY md5('42|' || sample_id || '|' || l), k) FROM (SELECT unnest(neg) AS l, generate_subscripts(neg, 1) AS k))[1:3] AS n FROM v_sample)""", "v_sample"))
def j1(spark, d):
    x = pairs.training_pairs(t.v_sample(spark, d))
    return x.select("sample_id", "pos_no", "anchor", "positive", joined("negatives"))


@query("j2_ir_dataset", sql("SELECT 'q_' || sample_id AS query_id, md5(l) AS corpus_id, 'query: ' || query AS text, 'passage: ' || l AS label FROM (SELECT DISTINCT sample_id, query, unnest(pos) AS l FROM v_sample)", "v_sample"))
def j2(spark, d):
    queries, corpus, qrels = pairs.ir_dataset(t.v_sample(spark, d))
    return qrels.join(queries, "query_id").join(corpus.select("corpus_id", F.col("text").alias("label")), "corpus_id")


@query("j2_ir_corpus", sql("SELECT DISTINCT md5(l) AS corpus_id, 'passage: ' || l AS text FROM (SELECT unnest(list_concat(pos, neg)) AS l FROM v_sample WHERE len(pos) > 0)", "v_sample"))
def j2b(spark, d):
    return pairs.ir_dataset(t.v_sample(spark, d))[1]
