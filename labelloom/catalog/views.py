"""The views of sources.tables as DuckDB text, for the twins."""

# a word: run of characters that are no Unicode blank (RE2 notation)
WORD = r"[^\s\x0B\x{1c}-\x{1f}\x{85}\p{Z}]+"

VIEWS = {
    "v_item": ("SELECT p_partkey, concat(p_name, ' ', p_brand) AS label, p_name AS coarse_label, p_type, p_size FROM part", []),
    "v_sample_label": ("""SELECT l_orderkey AS sample_id, label, coarse_label, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS pos_no, l_returnflag = 'R' AS is_neg
        FROM lineitem JOIN v_item ON l_partkey = p_partkey""", ["v_item"]),
    "v_sample": ("""SELECT o_orderkey AS sample_id, o_orderkey AS row_no, concat(o_orderpriority,' ',o_orderstatus,' ',o_orderkey) AS query,
        coalesce(list(label ORDER BY pos_no) FILTER (NOT is_neg), []) AS pos,
        coalesce(list(label ORDER BY pos_no) FILTER (is_neg), []) AS neg
        FROM v_sample_label JOIN orders ON sample_id = o_orderkey GROUP BY ALL""", ["v_sample_label"]),
    "v_skill": ("""SELECT label, max_by(p_type, p_partkey) AS description, max(p_partkey) AS row_no,
        max_by(p_size, p_partkey) AS size FROM v_item GROUP BY label""", ["v_item"]),
    "v_skill_occ": ("SELECT DISTINCT label, l_suppkey AS occupation FROM lineitem JOIN v_item ON l_partkey = p_partkey", ["v_item"]),
    "v_skill_partial": ("SELECT * FROM v_skill WHERE size > 12", ["v_skill"]),
    "v_text": ("SELECT doc_id, text AS query, lang, source, n_chars FROM documents", []),
    "v_text_sample": ("SELECT doc_id AS sample_id, doc_id AS row_no, text AS query, [source] AS pos, [lang] AS neg FROM documents", []),
    "v_real": ("SELECT DISTINCT d.text AS query FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1", []),
    "v_vec": ("SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings", []),
    "v_response": ("SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'", []),
    "v_doc": ("""SELECT a.label, a.description, coalesce(o.occupations, []) AS occupations FROM
        (SELECT label, string_agg(t, ', ' ORDER BY t) AS description FROM (SELECT DISTINCT label, concat(p_type, ' part of size ', p_size) AS t FROM v_item) GROUP BY label) a
        LEFT JOIN (SELECT label, list(CAST(occupation AS VARCHAR) ORDER BY CAST(occupation AS VARCHAR)) AS occupations FROM v_skill_occ GROUP BY label) o
        ON a.label = o.label""", ["v_item", "v_skill_occ"]),
    "v_kw": ("""SELECT * FROM (VALUES (1,'S1','ring'),(1,'S1','gear'),(2,'S2','bolt'),(2,'S2','rod'),(3,'K1','plate'),(3,'K1','anvil'),
        (4,'T1','widget'),(4,'T1','gizmo'),(5,'L1','red'),(5,'L1','blue')) AS t(ord, code, kw)""", []),
    "v_text_kw": ("""SELECT * FROM (VALUES (1,'T2','that'),(1,'T2','was'),(2,'S3','des'),(2,'S3','les'),(3,'K2','der'),(3,'K2','die'),
        (3,'K2','und'),(4,'L2','los'),(4,'L2','del'),(4,'L2','que')) AS t(ord, code, kw)""", []),
}


def words(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{WORD}'))"


def sql(body: str, *views: str, **extra: str) -> str:
    """WITH the named views (and what they need) in front of the body; ``extra`` adds named CTEs after them."""
    order: list[str] = []

    def need(name):
        for dep in VIEWS[name][1]:
            need(dep)
        if name not in order:
            order.append(name)

    for v in views:
        need(v)
    ctes = [f"{n} AS ({VIEWS[n][0]})" for n in order] + [f"{n} AS ({t})" for n, t in extra.items()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
