"""The registered queries in the SQL of an independent engine.

Nothing here is used to compute results; it is what they are compared with.
"""

PAIRS = """
select conv_id, turn, text as instruction, nxt as output, sys as input
from (select conv_id, turn, role, text,
             lead(text) over (partition by conv_id order by turn) as nxt,
             lead(role) over (partition by conv_id order by turn) as nrole,
             max(case when role = 'system' then text end) over (partition by conv_id) as sys
      from conversations) t
where role = 'user' and nrole = 'assistant'
"""

MOVIES = """
select p_partkey as id, p_name as title,
       case when p_size % 3 = 0 then null when p_size % 3 = 1 then '' else p_brand end as tagline,
       case when p_size % 5 = 0 then '' else concat('About ', p_name) end as overview,
       case when p_size % 7 = 0 then '' else concat(p_type, ', ', p_brand) end as genres,
       case when p_size % 4 = 0 then '' else p_name end as keywords,
       case when p_size % 7 = 0 then 0 else 2 end as n_genres,
       p_retailprice as vote_average, cast(p_size as bigint) as vote_count,
       p_retailprice / 100 as popularity, '2001-01-01' as release_date,
       cast(p_size as double) as runtime
from part
"""

TRAIN_LOG = """
select event_id as step, case when event_type <> 'error' then value end as loss from events
"""

LINES = f"""
select step,
       'Step ' || step || ': Loss ' || coalesce(cast(loss as varchar), 'N/A') || chr(10) as line
from ({TRAIN_LOG}) t
"""

_ALPACA_PROMPT = """
'### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
|| case when coalesce(input, '') <> ''
        then '### Input:' || chr(10) || input || chr(10) || chr(10) else '' end
|| '### Response:' || chr(10)
"""

ALPACA = f"""
select *, {_ALPACA_PROMPT} || coalesce(output, 'None') || '</s>' as text from ({PAIRS}) p
"""

_TURN = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"

CHAT = f"""
select conv_id, string_agg({_TURN}, '' order by turn) || '<|im_end|>' as text
from conversations group by conv_id
"""


def _movie(tagline: str, eos: str) -> str:
    def shown(name: str) -> str:
        return f"coalesce(cast({name} as varchar), 'None')"

    return f"""
'### Instruction:' || chr(10)
|| 'Generate a persuasive movie recommendation for a user. Highlight why they should watch '
|| 'the movie using its genre, themes, storyline, and popularity.' || chr(10) || chr(10)
|| '### Movie Metadata:' || chr(10)
|| 'Title: ' || {shown('title')} || chr(10)
|| 'Tagline: ' || {tagline} || chr(10)
|| 'Overview: ' || case when overview = '' then 'No overview available.' else overview end || chr(10)
|| 'Genres: ' || genres || chr(10)
|| 'Keywords: ' || keywords || chr(10)
|| 'Vote Average: ' || {shown('vote_average')} || chr(10)
|| 'Vote Count: ' || {shown('vote_count')} || chr(10)
|| 'Popularity: ' || {shown('popularity')} || chr(10)
|| 'Release Date: ' || {shown('release_date')} || chr(10)
|| 'Runtime: ' || {shown('runtime')} || ' minutes' || chr(10) || chr(10)
|| '### Response:' || chr(10)
|| 'Here’s why you might enjoy this movie:' || chr(10) || '{eos}'
"""


def _tokens(text: str) -> str:
    return f"regexp_extract_all({text}, '[^ \\t\\r\\n]+')"


def _vocabulary(source: str, size: int) -> str:
    return f"""
select row_number() over (order by n desc, token) as id, token, n as count
from (select token, count(*) as n
      from (select unnest({_tokens('text')}) as token from ({source}) s) t
      group by token order by n desc, token limit {size}) c
"""


def _encoded(source: str, keys: str, size: int, length: int | None, value: str) -> str:
    end = "" if length is None else f"[1:{length}]"
    joined = " and ".join(f"i.{key} = s.{key}" for key in keys.split(", "))
    return f"""
with source as ({source}),
vocabulary as ({_vocabulary('select * from source', size)}),
spread as (select *, generate_subscripts(tokens, 1) as pos, unnest(tokens) as token
           from (select *, {_tokens('text')}{end} as tokens from source) a),
ids as (select {', '.join('spread.' + key for key in keys.split(', '))},
               string_agg(cast({value} as varchar), ',' order by pos) as value
        from spread left join vocabulary using (token) group by all)
select {', '.join('s.' + key for key in keys.split(', '))}, coalesce(i.value, '') as value
from source s left join ids i on {joined}
"""


_ALPACA_WITH_PROMPT = f"select *, {_ALPACA_PROMPT} as prompt_text from ({ALPACA}) a"

_OTHER = "((k % n - x + n) % n)"
_MIXED = f"((greatest(x, {_OTHER}) % 2147483647 * 48271 + k % 2147483647) % 2147483647 * 69621 % 2147483647)"

#: Damaged lines by folder.
FAULTY = """
select lang, count(*) as rows_read, sum((source = 'src1')::bigint)::bigint as bad
from documents group by lang having bad > 0"""

ORACLE = {
    "s1_load_split": "select doc_id, lang, text from documents where lang = 'en'",
    "s2_pick_split": "select doc_id, lang, text from documents where lang = 'de'",
    "s2_all_splits": "select doc_id, text, lang as split from documents",
    "s4_faulty_json": FAULTY,
    "s4_faulty_csv": FAULTY,
    "s3_head_sample": "select * from documents order by doc_id limit 100",
    "s3_head_by_file": "select * from documents order by doc_id limit 150",
    "s3_head_of_split": "select * from documents where lang = 'en' order by doc_id limit 150",
    "s3_head_large": "select * from lineitem order by l_orderkey, l_linenumber limit 3000",
    "s5_roundtrip": ALPACA,
    "s5_sorted_json": ALPACA,
    "s5_whole_job": """
select doc_id, text, lang, source, n_chars, position, position // 2 as micro_batch,
       position // 8 as step
from (select *, row_number() over (order by md5('3407:' || doc_id), doc_id) - 1 as position
      from documents) p""",
    "s5_job_tokenized": "select doc_id, position, value as ids from ("
    + _encoded("select doc_id, text from documents", "doc_id", 32000, 2048, "coalesce(id, 0)")
    + """) e join (select doc_id, row_number() over (order by md5('3407:' || doc_id), doc_id) - 1
                          as position from documents) p using (doc_id)""",
    "o1_job_sample": """
select doc_id, text, lang, source, n_chars, position, position // 2 as micro_batch,
       position // 8 as step
from (select *, row_number() over (order by md5('3407:' || doc_id), doc_id) - 1 as position
      from (select * from documents order by md5('42:' || doc_id), doc_id limit 100) s) p""",
    "s6_dry_run": """
select count(*) as n_rows, count(*) - count(text) as unrendered,
       cast(ceil(ceil(ceil(count(*) / 2.0) / 4.0) * 3.0) as bigint) as steps
from documents""",
    "s7_preview_raw": f"select * from ({PAIRS}) p order by conv_id, turn limit 5",
    "s8_preview_formatted": f"select * from ({ALPACA}) p order by conv_id, turn limit 3",
    "m6_positional_fallback": """
select source, lang, doc_id,
       '### Instruction:' || chr(10) || coalesce(source, 'None') || chr(10) || chr(10)
       || '### Response:' || chr(10) || coalesce(lang, 'None') || '</s>' as text
from documents""",
    "m7_forced_alpaca_positional": """
select lang, source,
       '### Instruction:' || chr(10) || coalesce(lang, 'None') || chr(10) || chr(10)
       || case when coalesce(source, '') <> ''
               then '### Input:' || chr(10) || source || chr(10) || chr(10) else '' end
       || '### Response:' || chr(10) || coalesce(text, 'None') || '</s>' as text
from documents""",
    "p1_rename_content": "select page_id, html as text from pages",
    "p2_text_only": f"select text from ({CHAT}) c",
    "f1_auto_documents": "select * from documents",
    "f2_alpaca": ALPACA,
    "f2_alpaca_no_input": f"""
select conv_id, turn, instruction, output,
       '### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
       || '### Response:' || chr(10) || output || '</s>' as text
from ({PAIRS}) p""",
    "f3_movie": f"select id, {_movie('''coalesce(tagline, '')''', '</s>')} as text from ({MOVIES}) m",
    "f3_movie_notebook": f"select {_movie('''coalesce(tagline, '')''', '')} as text from ({MOVIES}) m",
    "f3_movie_no_tagline": f"select id, {_movie(chr(39) * 2, '</s>')} as text from ({MOVIES}) m",
    "f4_chat": CHAT,
    "f4_chat_long": f"""
select conv_id // 500 as conv_id, string_agg({_TURN}, '' order by conv_id, turn) || '<|im_end|>' as text
from conversations group by conv_id // 500""",
    "m4_chat_detected": CHAT,
    "f5_passthrough": "select doc_id, text, source from documents",
    "f7_instruction_prompt": f"""
select conv_id, turn,
       'Below is an instruction that describes a task.' || chr(10) || chr(10)
       || '### Instruction:' || chr(10) || instruction || chr(10) || chr(10)
       || '### Response:' || chr(10) as prompt
from ({PAIRS}) p""",
    "f8_generation_prompt": f"""
select conv_id, turn,
       '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10)
       || '<|im_start|>assistant' || chr(10) as prompt
from ({PAIRS}) p""",
    "f9_sharegpt": CHAT,
    "f10_assemble": """
select conv_id, count(*) as turns, string_agg(role, ',' order by turn) as roles
from conversations group by conv_id""",
    "f12_strip_special": f"""
select conv_id, replace(replace(text, '<|im_start|>', ''), '<|im_end|>', '') as text
from ({CHAT}) c""",
    "x1_py_str": """
select event_id,
       strftime(ts, '%Y-%m-%d %H:%M:%S')
       || case when strftime(ts, '%f') <> '000000' then strftime(ts, '.%f') else '' end as ts_text,
       coalesce(cast(value as varchar), 'None') as value_text,
       coalesce(cast(value * 1000000 as varchar), 'None') as large_text,
       coalesce(cast(case when event_type <> 'error' then value end as varchar), 'None') as loss_text,
       case when event_type = 'error' then 'True' else 'False' end as failed_text,
       coalesce(props, 'None') as props_text
from events""",
    "x1_py_str_orders": """
select o_orderkey, cast(o_custkey as varchar) as custkey_text,
       cast(o_totalprice as varchar) as totalprice_text,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as orderdate_text,
       coalesce(o_orderpriority, 'None') as orderpriority_text
from orders""",
    "x1_py_str_nested": r"""
select conv_id, turn, '[' || conv_id || ', ' || turn || ']' as numbers_text,
       '[''' || role || ''', ' || case when contains(shown, '''') and not contains(shown, '"')
              then '"' || shown || '"'
              else '''' || replace(shown, '''', '\''') || '''' end || ']' as strings_text,
       '{''turn'': ' || turn || ', ''by'': {''role'': ''' || role || '''}}' as fields_text,
       '[(''' || role || ''', [' || turn || '])]' as entries_text
from (select *, replace(replace(replace(replace(text, '\', '\\'), chr(10), '\n'), chr(13), '\r'),
             chr(9), '\t') as shown
      from conversations) t""",
    "x2_truthy": f"""
select id, cast(coalesce(tagline, '') <> '' as bigint) as tagline_true,
       cast(coalesce(overview, '') <> '' as bigint) as overview_true,
       cast(vote_count % 3 <> 0 as bigint) as rest_true,
       cast(runtime is not null and runtime <> 0 as bigint) as runtime_true
from ({MOVIES}) m""",
    "x3_default_if_falsy": f"""
select id, case when coalesce(overview, '') = '' then 'No overview available.' else overview end
       as overview, coalesce(tagline, '') as tagline
from ({MOVIES}) m""",
    "x4_names": f"""
select id, cast(n_genres as bigint) as n_genres, replace(genres, ', ', '|') as genres, keywords
from ({MOVIES}) m""",
    "x5_joined_names": f"select id, genres, keywords from ({MOVIES}) m",
    "t1_vocab": _vocabulary("select text from documents", 1000),
    "t1_vocab_large": _vocabulary("select text from documents", 1_000_000),
    "t2_encode": "select conv_id, turn, value as ids from ("
    + _encoded(_ALPACA_WITH_PROMPT, "conv_id, turn", 500, 64, "coalesce(id, 0)")
    + ") e",
    "t2_encode_documents": "select doc_id, value as ids from ("
    + _encoded("select doc_id, text from documents", "doc_id", 1000, None, "coalesce(id, 0)")
    + ") e",
    "t2_encode_join": "select doc_id, value as ids from ("
    + _encoded("select doc_id, text from documents", "doc_id", 1000, None, "coalesce(id, 0)")
    + ") e",
    "t2_encode_large": "select doc_id, value as ids from ("
    + _encoded("select doc_id, text from documents", "doc_id", 300_000, None, "coalesce(id, 0)")
    + ") e",
    "t3_truncate": f"""
select doc_id, array_to_string({_tokens('text')}[1:64], ' ') as text from documents""",
    "t4_labels": "select conv_id, turn, value as labels from ("
    + _encoded(
        _ALPACA_WITH_PROMPT,
        "conv_id, turn",
        500,
        64,
        f"case when pos <= len({_tokens('prompt_text')}) then -100 else coalesce(id, 0) end",
    )
    + ") e",
    "o1_shuffle_take": """
select doc_id, lang, text, row_number() over (order by md5('42:' || doc_id), doc_id) - 1 as position
from documents order by position limit 100""",
    "o2_batches": """
select doc_id, text, position, position // 2 as micro_batch, position // 8 as step
from (select doc_id, text,
             row_number() over (order by md5('3407:' || doc_id), doc_id) - 1 as position
      from documents) p""",
    "o2_epochs": f"""
with placed as (
    select doc_id, row_number() over (order by md5('3407:' || doc_id), doc_id) - 1 as position, count(*) over () as n from documents
), passes as (
    select *, unnest(range(0, 3)) as epoch from placed
), moved as (
    select doc_id, position, n, epoch, case when epoch = 0 then position else list_reduce(
        list_prepend(position, list_transform(range(0, 24), lambda i: ('0x' || substr(md5('3407:' || epoch || ':' || i), 1, 15))::bigint)),
        lambda x, k: case when {_MIXED} // 1024 % 2 = 1 then {_OTHER} else x end) end as place
    from passes
)
select doc_id, position, epoch, place, epoch * ceil(n / 2)::bigint + place // 2 as micro_batch,
       epoch * ceil(ceil(n / 2) / 4)::bigint + place // 8 as step
from moved""",
    "o3_step_budget": f"""
select count(*) as n_rows,
       cast(ceil(ceil(ceil(count(*) / 2.0) / 4.0) * 3.0) as bigint) as steps_by_epochs,
       cast(60 as bigint) as steps_by_limit
from ({PAIRS}) p""",
    "l1_log_lines": LINES,
    "l2_log_text": f"""
select chunk, string_agg(line, '' order by step) as text
from (select step, line, (row_number() over (order by step) - 1) // 1000 as chunk
      from ({LINES}) l) c
group by chunk""",
    "l2_log_text_runs": """
select run, chunk, string_agg(line, '' order by step) as text
from (select event_type as run, event_id as step,
             'Step ' || event_id || ': Loss ' || coalesce(cast(value as varchar), 'N/A') || chr(10)
             as line,
             (row_number() over (partition by event_type order by event_id) - 1) // 1000 as chunk
      from events) c
group by run, chunk""",
    "l3_log_stream": LINES,
    "u4_log_hook": LINES,
    "x7_log_line_colon": f"""
select step,
       'Step ' || step || ': Loss: ' || coalesce(cast(loss as varchar), 'N/A') || chr(10) as line
from ({TRAIN_LOG}) t""",
    "l4_every_k": f"select * from ({LINES}) l where step % 25 = 0",
}

ORACLE["m8_column_report"] = """
select * from (values
    ('documents', 'text', 'text'), ('documents', 'chat', null), ('documents', 'instruction', null), ('documents', 'output', null), ('documents', 'input', null),
    ('pairs', 'text', null), ('pairs', 'chat', null), ('pairs', 'instruction', 'instruction'), ('pairs', 'output', 'output'), ('pairs', 'input', 'input'),
    ('chats', 'text', null), ('chats', 'chat', 'messages'), ('chats', 'instruction', null), ('chats', 'output', null), ('chats', 'input', null)
) as t(shape, part, column_name)"""
ORACLE["l2_log_text_stream"] = ORACLE["l2_log_text_runs"]
for _format in ("json", "csv", "text", "orc"):
    ORACLE[f"s3_head_{_format}"] = "select doc_id, lang, source from documents order by doc_id limit 333"
