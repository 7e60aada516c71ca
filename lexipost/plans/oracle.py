"""DuckDB SQL with the meaning of each registered query, over the same tables."""

from __future__ import annotations

from lexipost.functions.codes import GAMMA_BASE, RAW_BYTES, VB_BASE
from lexipost.operators.inversion import CHUNK_DOCS
from lexipost.plans.workload import BATCH, EDITED_BATCH

_BREAK = r"'\s+'"

_DOCS = """
docs as (select row_number() over (order by source, cast(doc_id as varchar)) - 1 as did,
                source || '/' || cast(doc_id as varchar) as path,
                source as block, cast(doc_id as varchar) as name, text
         from documents)"""

_TOK = f"""
tok0 as (select did, block, unnest(string_split_regex(text, {_BREAK})) as t,
                generate_subscripts(string_split_regex(text, {_BREAK}), 1) as p
         from docs),
tok as (select did, block, t, min(p) as p from tok0 where t <> '' group by did, block, t)"""

_LEX = """
lex as (select t, row_number() over (order by fd, fp) - 1 as tid, fd, df
        from (select t, arg_min(p, did) as fp, min(did) as fd, count(*) as df
              from tok group by t) as first_seen)"""

_POST = "post as (select tid, did, block, df from tok join lex using (t))"

_GAPS = f"""
gaps as (select tid, did, df, row_number() over w as rn,
                did - coalesce(lag(did) over w, {VB_BASE}) as vb_gap,
                did - coalesce(lag(did) over w, {GAMMA_BASE}) as gamma_gap,
                {{chunk}} as chunk
         from post window w as (partition by tid order by did))""".format(
    chunk=f"case when df > {CHUNK_DOCS} then did // {CHUNK_DOCS} + 1 else 0 end"
)


def _with(body: str, *parts: str) -> str:
    return "with " + ",".join(parts) + "\n" + body


def _index(body: str, *parts: str) -> str:
    return _with(body, _DOCS, _TOK, _LEX, _POST, *parts)


def _values(name: str, rows: list[tuple[int, str]]) -> str:
    listed = ", ".join(f"({qid}, '{query}')" for qid, query in rows)
    return f"{name}(qid, query) as (select cast(c0 as bigint), c1 from (values {listed}) as v(c0, c1))"


_ITEMS = "batch(qid, query) as (select item_id, text from benchmark)"


def _hits(name: str, batch: str) -> str:
    """CTEs that answer the queries of ``batch``."""
    return f"""
{name}_t as (select distinct qid, t
             from (select qid, unnest(string_split_regex(query, {_BREAK})) as t from {batch}) as q
             where t <> ''),
{name}_n as (select qid, count(*) as n from {name}_t group by qid),
{name} as (select qid, did, path
           from (select qid, did from {name}_t join tok using (t) join {name}_n using (qid)
                 group by qid, did, n having count(*) = n) as h
           join docs using (did))"""


def _answers(batch: str, columns: str = "qid, did as doc_id, path") -> str:
    return _with(f"select {columns} from hit", _DOCS, _TOK, batch, _hits("hit", "batch"))


_TWO_RESULTS = ",".join(
    [
        _DOCS,
        _TOK,
        _values("ours", BATCH),
        _values("theirs", EDITED_BATCH),
        _hits("l", "ours"),
        _hits("r", "theirs"),
        """
lr as (select *, row_number() over (partition by qid order by did) - 1 as rank from l),
rr as (select *, row_number() over (partition by qid order by did) - 1 as rank from r),
pairs as (select coalesce(lr.qid, rr.qid) as qid, coalesce(lr.rank, rr.rank) as rank,
                 lr.path as left_path, rr.path as right_path
          from lr full join rr on lr.qid = rr.qid and lr.rank = rr.rank)""",
    ]
)


def _raw_code() -> str:
    digits = f"format('{{:0{2 * RAW_BYTES}X}}', did)"
    return " || ".join(f"substr({digits}, {2 * i + 1}, 2)" for i in reversed(range(RAW_BYTES)))


def _vb_code() -> str:
    lead = [
        f"case when vb_gap >= {1 << 7 * i} "
        f"then format('{{:02X}}', 128 | ((vb_gap >> {7 * i}) & 127)) else '' end"
        for i in reversed(range(1, 9))
    ]
    return " || ".join([*lead, "format('{:02X}', vb_gap & 127)"])


_GAMMA_CODE = "repeat('1', length(bin(gamma_gap)) - 1) || '0' || substr(bin(gamma_gap), 2)"

_HEX_OF_BITS = """
array_to_string(list_transform(generate_series(1, length(bits), 4), lambda i:
    substr('0123456789ABCDEF', 1 + 8 * cast(substr(bits, i, 1) as int)
        + 4 * cast(substr(bits, i + 1, 1) as int) + 2 * cast(substr(bits, i + 2, 1) as int)
        + cast(substr(bits, i + 3, 1) as int), 1)), '')"""


def _packed(code: str) -> str:
    return (
        "select tid, chunk, count(*) as n_postings, "
        f"string_agg({code}, '' order by did) as payload from gaps group by tid, chunk"
    )


def _whole(code: str) -> str:
    return (
        "select tid as term_id, count(*) as n_postings, "
        f"string_agg({code}, '' order by did) as payload from gaps group by tid"
    )


def _gamma_hex(columns: str, packed: str) -> str:
    """``packed`` with its bit text filled up with ones and written in hex."""
    return _index(
        f"select {columns}, {_HEX_OF_BITS} as payload from (select *, "
        f"payload || repeat('1', (8 - length(payload) % 8) % 8) as bits from ({packed}) as e) as f",
        _GAPS,
    )


def _encoded(code: str) -> str:
    return _index(
        f"select tid as term_id, cast(chunk as bigint) as chunk, n_postings, payload "
        f"from ({_packed(code)}) as e",
        _GAPS,
    )


_SIZES = f"""
sizes as (select tid, count(*) as n,
                 cast({RAW_BYTES} * count(*) as bigint) as raw,
                 cast(sum((length(bin(vb_gap)) + 6) // 7) as bigint) as vb,
                 cast((sum(2 * length(bin(gamma_gap)) - 1) + 7) // 8 as bigint) as gamma
          from gaps group by tid)"""

_CODECS = ("raw", "vb", "gamma")

_POSTINGS = _index("select tid as term_id, did as doc_id from post")
_LEXICON = _with("select t as term, tid as term_id, df from lex", _DOCS, _TOK, _LEX)
_BATCH_ANSWERS = _answers(_values("batch", BATCH))
_ITEM_ANSWERS = _answers(_ITEMS)
_ITEM_TERMS = f"""
(select distinct t from (select unnest(string_split_regex(text, {_BREAK})) as t from benchmark) as b
 where t <> '')"""

ORACLE: dict[str, str] = {
    "documents_catalog": _with("select block, name, path, text from docs", _DOCS),
    "tokenize": _with(
        "select path, cast(pos - 1 as bigint) as pos, token from (select path, "
        "unnest(words) as token, generate_subscripts(words, 1) as pos from (select path, "
        f"list_filter(string_split_regex(text, {_BREAK}), lambda w: w <> '') as words "
        "from docs) as s) as u",
        _DOCS,
    ),
    "query_tokens": _with(
        "select qid, t as term, n as n_terms from hit_t join hit_n using (qid)",
        _DOCS,
        _TOK,
        _ITEMS,
        _hits("hit", "batch"),
    ),
    "normalize_paths": _with(
        "select unnest(['./' || path, block || '\\' || name, block || '//' || name || '/', "
        "'a/../' || block || '/./' || name]) as written, path from docs",
        _DOCS,
    ),
    "doc_dictionary": _with("select did as doc_id, path, block, name from docs", _DOCS),
    "doc_term_pairs": _with(
        "select did as doc_id, t as term, "
        "row_number() over (partition by did order by p) - 1 as pos from tok",
        _DOCS,
        _TOK,
    ),
    "lexicon": _LEXICON,
    "lexicon_extend": _LEXICON,
    "index_extend": _POSTINGS,
    "index_compact": _POSTINGS,
    "merge_indexes": _index("select t as term, tid as term_id, did as doc_id, df from post join lex using (tid, df)"),
    "retrieve_extended": _BATCH_ANSWERS,
    "retrieve_extended_joined": _ITEM_ANSWERS,
    "term_to_id": _with(
        f"select t as term, tid as term_id from lex join {_ITEM_TERMS} as i using (t)",
        _DOCS,
        _TOK,
        _LEX,
    ),
    "id_to_term": _with("select tid as term_id, df, t as term from lex", _DOCS, _TOK, _LEX),
    "id_to_path": _with(
        "select tid as term_id, did as doc_id, path from lex join docs on did = fd",
        _DOCS,
        _TOK,
        _LEX,
    ),
    "dictionary_sizes": _with(
        "select 'docs' as dictionary, count(*) as n_entries from docs "
        "union all select 'terms', count(*) from lex",
        _DOCS,
        _TOK,
        _LEX,
    ),
    "postings": _POSTINGS,
    "posting_lists": _index(
        "select tid as term_id, cast(chunk as bigint) as chunk, "
        "string_agg(cast(did as varchar), ' ' order by did) as doc_ids from gaps group by tid, chunk",
        _GAPS,
    ),
    "block_segments": _index("select block, tid as term_id, did as doc_id from post"),
    "merge_segments": _POSTINGS,
    "build_index": _with("select t as term, path from tok join docs using (did)", _DOCS, _TOK),
    "index_scan": _POSTINGS,
    "term_df": _with("select tid as term_id, df from lex", _DOCS, _TOK, _LEX),
    "term_stats": _index(
        " union all ".join(
            f"select '{c}' as codec, tid as term_id, cast(coalesce(sum({c}) over (order by tid "
            f"rows between unbounded preceding and 1 preceding), 0) as bigint) as start_pos, "
            f"n as n_postings, {c} as n_bytes from sizes"
            for c in _CODECS
        ),
        _GAPS,
        _SIZES,
    ),
    "index_size_report": _index(
        " union all ".join(
            f"select '{c}' as codec, count(*) as n_terms, cast(sum(n) as bigint) as n_postings, "
            f"cast(sum({c}) as bigint) as n_bytes from sizes"
            for c in _CODECS
        ),
        _GAPS,
        _SIZES,
    ),
    "postings_lookup": _with(
        f"select t as term, did as doc_id from tok join {_ITEM_TERMS} as i using (t)", _DOCS, _TOK
    ),
    "postings_intersect": _with(
        "select did as doc_id from tok where t = 'the' "
        "intersect select did from tok where t = 'of'",
        _DOCS,
        _TOK,
    ),
    "retrieve": _BATCH_ANSWERS,
    "retrieve_by_division": _BATCH_ANSWERS,
    "retrieve_rarest_first": _BATCH_ANSWERS,
    "retrieve_by_scan": _answers(_values("batch", BATCH), "qid, path"),
    "retrieve_by_scan_joined": _answers(_ITEMS, "qid, path"),
    "retrieve_by_bitmaps": _BATCH_ANSWERS,
    "retrieve_by_bitmaps_joined": _ITEM_ANSWERS,
    "retrieve_items": _ITEM_ANSWERS,
    "retrieve_items_joined": _ITEM_ANSWERS,
    "retrieve_raw": _BATCH_ANSWERS,
    "retrieve_vb": _BATCH_ANSWERS,
    "retrieve_gamma": _BATCH_ANSWERS,
    "result_difference": "with "
    + _TWO_RESULTS
    + "\nselect qid, path, 'left' as side from (select qid, path from l except select qid, path from r) as a"
    " union all select qid, path, 'right' from (select qid, path from r except select qid, path from l) as b",
    "validate_results": "with "
    + _TWO_RESULTS
    + """
select qid, count(left_path) as n_left, count(right_path) as n_right,
       coalesce(bool_and(left_path is not distinct from right_path), true) as passed
from ours left join pairs using (qid) group by qid""",
    "first_mismatch": "with "
    + _TWO_RESULTS
    + """
select qid, rank, left_path, right_path from pairs
where left_path is distinct from right_path
qualify row_number() over (partition by qid order by rank) = 1""",
    "result_files": _answers(_values("batch", BATCH), "qid, path"),
    "corpus_files": _with("select block, name, text from docs", _DOCS),
    "query_files": "select item_id as qid, text as query from benchmark",
    "expected_files": _answers(
        _values("batch", BATCH),
        "qid, row_number() over (partition by qid order by did) - 1 as rank, path",
    ),
    "gaps": _index("select tid as term_id, did as doc_id, vb_gap as gap from gaps", _GAPS),
    "gaps_to_postings": _POSTINGS,
    "encode_raw": _encoded(_raw_code()),
    "encode_vb": _encoded(_vb_code()),
    "encode_gamma": _gamma_hex(
        "tid as term_id, cast(chunk as bigint) as chunk, n_postings", _packed(_GAMMA_CODE)
    ),
    "encode_vb_cut": _index(_whole(_vb_code()), _GAPS),
    "encode_gamma_cut": _gamma_hex("term_id, n_postings", _whole(_GAMMA_CODE)),
    "decode_gamma_cut": _POSTINGS,
    "retrieve_cut": _BATCH_ANSWERS,
    "retrieve_gamma_joined": _ITEM_ANSWERS,
    "decode_raw": _POSTINGS,
    "decode_vb": _POSTINGS,
    "decode_gamma": _POSTINGS,
    "codec_roundtrip": _index(
        " union all ".join(
            f"select '{c}' as codec, count(*) as n_postings, cast(0 as bigint) as n_mismatches "
            "from post"
            for c in _CODECS
        )
    ),
}
ORACLE["term_stats_cut"] = ORACLE["term_stats"]
