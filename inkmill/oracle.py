"""DuckDB SQL that states the core queries a second time, on the same tables."""

from __future__ import annotations

from inkmill.functions.language import WORDS
# The white-space set, line ends and tokens of the text functions, in RE2's spelling.
_WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_NL = r"\r\n|[\n\x{0b}\x{0c}\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_TOKEN = r"[\p{L}\p{M}]+|\p{N}{1,3}|[^\s\p{L}\p{M}\p{N}]+"
_PIECE = r"(?s).+?(?:[.!?]+[\"''”»’)]*\s+|\n+|\z)"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(c: str) -> str:
    return f"array_to_string(list_filter(list_transform(string_split_regex(coalesce({c}, ''), '{_NL}'), lambda x: {_strip('x')}), lambda x: x <> ''), chr(10))"


def _tokens(c: str) -> str:
    return f"coalesce(len(regexp_extract_all({c}, '{_TOKEN}')), 0)"


def _unit(c: str) -> str:
    return f"(concat('0x', substr(sha256({c}), 1, 8))::BIGINT / 4294967296.0)"


def _split(c: str) -> str:
    return f"CASE WHEN {_unit(c)} < 0.05 THEN 'test' WHEN {_unit(c)} < 0.9500000000000001 THEN 'train' ELSE 'validation' END"


def _sha1_first(order: str = "doc_id") -> str:
    return f"row_number() OVER (PARTITION BY sha1(text) ORDER BY {order}) = 1"


def oracle_sql() -> dict[str, str]:
    from inkmill.queries import CHUNK_TOKENS, DEFAULT_QUOTA, FILTER, QUOTAS

    # records once each, documents and conversations as ingested
    recs = "recs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingested_at) AS rn FROM records WHERE id IS NOT NULL) WHERE rn = 1)"
    docs = f"docs AS (SELECT 'sha256:' || sha256('documents:' || doc_id) AS id, {_clean('text')} AS response, doc_id::VARCHAR AS original_id, source_path FROM documents WHERE {_clean('text')} <> '')"
    convs = """numbered AS (SELECT *, row_number() OVER (ORDER BY ingested_at, id NULLS FIRST) - 1 AS i FROM conversations),
        named AS (SELECT *, coalesce(nullif(id, ''), 'item_' || i) AS sid FROM numbered),
        once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY ingested_at, id NULLS FIRST) AS rn FROM named) WHERE rn = 1),
        turns AS (SELECT sid, t AS k, conversations[t - 1]."from" AS f0, conversations[t - 1]."value" AS v0, conversations[t]."from" AS f1, conversations[t]."value" AS v1 FROM once, unnest(range(2, len(conversations) + 1)) AS u(t)),
        hits AS (SELECT * FROM turns WHERE (contains(lower(f1), 'assistant') OR contains(lower(f1), 'gpt')) AND (contains(lower(f0), 'human') OR contains(lower(f0), 'user'))),
        lastp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY k DESC) AS rn FROM hits) WHERE rn = 1),
        pairs AS (SELECT 'sha256:' || sha256('conversations:' || sid) AS id, v0 AS prompt, v1 AS response, sid AS original_id FROM lastp WHERE length(v0) > 0 AND length(v1) > 0)"""
    content = "trim(json_extract_string(envelope, '$.choices[0].message.content'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')"
    reply = f"CASE WHEN json_valid(envelope) THEN {content} END"
    genre = "coalesce(" + ", ".join(f"CASE WHEN contains(low, '{g}') THEN '{g}' END" for g in [*_GENRES, "unknown"]) + ", 'unknown')"
    rubric = "CASE WHEN regexp_full_match(t, 'story_.*') OR t = 'poetry' THEN 'narrative_creative' WHEN regexp_full_match(t, '[fghn].*_.*') THEN 'academic_informative' WHEN regexp_full_match(t, 'blog_pos.') THEN 'entertainment_personal' WHEN t = 'memoir' THEN 'professional' ELSE 'default' END"
    in_range = f"length(text) > 0 AND {_tokens('text')} BETWEEN {FILTER.min_tokens} AND {FILTER.max_tokens}"
    clean = "NOT coalesce(regexp_matches(text, '(?i)<p>'), false) AND NOT coalesce(regexp_matches(text, '(?i)isbn [0-9]'), false)"
    english = _english("text")
    quota = "CASE top " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in QUOTAS.items()) + f" ELSE {DEFAULT_QUOTA} END"
    known = ", ".join(f"'{n}.{m}'" for n, ms in _METRICS.items() for m in ms.split())
    scores = f"{recs}, sc AS (SELECT id, e.key AS metric, e.value AS score FROM recs, unnest(map_entries(scores)) AS u(e)), pct AS (SELECT metric, count(*) AS n, quantile_cont(score, 0.05) AS lo, quantile_cont(score, 0.95) AS hi, min(score) AS least, max(score) AS most FROM sc WHERE score IS NOT NULL AND metric IN ({known}) GROUP BY metric HAVING count(*) >= 2)"
    # the scores of each record under the rubric that has most of them
    complete = f"own AS (SELECT id, split_part(metric, '.', 1) AS rubric, count(DISTINCT metric) AS n FROM sc WHERE score IS NOT NULL AND metric IN ({known}) GROUP BY 1, 2), best AS (SELECT id, max(n) AS n FROM own GROUP BY id)"
    sents = f"""pieces AS (SELECT doc_id, u.n - 1 AS n, ps[u.n] AS piece FROM (SELECT doc_id, regexp_extract_all(text, '{_PIECE}') AS ps FROM documents WHERE text IS NOT NULL) d, unnest(range(1, len(ps) + 1)) AS u(n)),
        sents AS (SELECT doc_id, n, {_strip('piece')} AS sentence, piece FROM pieces)"""
    placed = f"""{sents}, offs AS (SELECT doc_id, n, sentence, {_tokens('sentence')} AS tokens, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(piece) - length(regexp_replace(piece, '^{_WS}+', '')) AS s FROM sents),
        num AS (SELECT *, s + length(sentence) AS e, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS i FROM offs WHERE sentence <> ''),
        walk AS (SELECT doc_id, i, 0 AS chunk, tokens AS total, s, e, sentence FROM num WHERE i = 1 UNION ALL
            SELECT b.doc_id, b.i, CASE WHEN w.total + b.tokens > {CHUNK_TOKENS} THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN w.total + b.tokens > {CHUNK_TOKENS} THEN b.tokens ELSE w.total + b.tokens END, b.s, b.e, b.sentence FROM walk w JOIN num b ON b.doc_id = w.doc_id AND b.i = w.i + 1)"""
    # the same walk with one sentence carried over, and over the ingested documents
    over = f"w.total + b.tokens > {CHUNK_TOKENS}"
    carried = placed[: placed.index("walk AS")] + f"""walk AS (SELECT doc_id, i, 0 AS chunk, tokens AS total, 1 AS n, tokens AS own, s, s AS first, e FROM num WHERE i = 1 UNION ALL
            SELECT b.doc_id, b.i, CASE WHEN {over} THEN w.chunk + 1 ELSE w.chunk END, CASE WHEN NOT {over} THEN w.total + b.tokens WHEN w.n > 1 THEN w.own + b.tokens ELSE b.tokens END,
            CASE WHEN NOT {over} THEN w.n + 1 WHEN w.n > 1 THEN 2 ELSE 1 END, b.tokens, b.s, CASE WHEN NOT {over} THEN w.first WHEN w.n > 1 THEN w.s ELSE b.s END, b.e FROM walk w JOIN num b ON b.doc_id = w.doc_id AND b.i = w.i + 1)"""
    longer = placed.replace("text", "response").replace("FROM documents WHERE response IS NOT NULL", f"FROM docs WHERE {_tokens('response')} > {CHUNK_TOKENS * 1.1}").replace("doc_id", "original_id")
    metric_keys = ", ".join(sorted({f"'{m}'" for ms in _METRICS.values() for m in ms.split()}))
    return {
        "reconstruction_prompt": _reconstruction_prompt(recs),
        "score_prompt": _score_prompt(recs, rubric),
        "score_parse_native": f"""SELECT reply_id, k AS metric, least(1.0, greatest(0.0, v::DOUBLE)) AS score FROM (SELECT reply_id, k, json_extract_string(c, '$."' || k || '"') AS v FROM (SELECT reply_id, c, unnest(json_keys(c)) AS k FROM (SELECT reply_id, {reply} AS c FROM judge_replies WHERE stage = 'score') WHERE regexp_full_match(c, '{_FLAT}')))
            WHERE k IN ({metric_keys}) AND regexp_full_match(v, '-?[0-9]+(\\.[0-9]+)?([eE][-+]?[0-9]+)?')""",
        "segment_overlap": f"WITH RECURSIVE {carried} SELECT doc_id, chunk, min(first) AS start_pos, max(e) AS end_pos FROM walk GROUP BY doc_id, chunk",
        "segment_chunks": f"WITH RECURSIVE {docs}, {longer} SELECT 'sha256:' || sha256('documents:' || original_id || ':seg:' || chunk) AS id, string_agg(sentence, ' ' ORDER BY i) AS response, min(s)::INT AS start_pos, max(e)::INT AS end_pos FROM walk GROUP BY original_id, chunk UNION ALL SELECT id, response, NULL, NULL FROM docs WHERE NOT {_tokens('response')} > {CHUNK_TOKENS * 1.1}",
        "ingest_standalone": f"WITH {docs} SELECT id, response, original_id FROM docs",
        "ingest_longform": f"WITH {docs} SELECT id, length(response) AS chars, source_path FROM docs",
        "ingest_pairs": f"WITH {convs} SELECT id, prompt, response, original_id, 'human' AS prompt_type FROM pairs",
        "union_sources": f"WITH {docs}, {convs} SELECT 'documents' AS source_dataset_name, count(*) AS records, 0 AS prompts FROM docs UNION ALL SELECT 'conversations', count(*), count(prompt) FROM pairs",
        "limit_int": "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 25",
        "limit_percent": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 12.5 / 100)",
        "clean_text": f"SELECT doc_id, {_clean('text')} AS text FROM documents",
        "one_line": "SELECT doc_id, replace(text, chr(10), ' ') AS text FROM documents",
        "record_ids": "SELECT doc_id, 'sha256:' || sha256('docs:contenthash:' || substr(sha256(text), 1, 16) || ':seg:' || (doc_id % 3)) AS id FROM documents WHERE text <> '' UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL OR text = ''",
        "token_count": f"SELECT doc_id, {_tokens('text')} AS tokens FROM documents",
        "filter_length": f"SELECT doc_id FROM documents WHERE {in_range}",
        "filter_language": f"SELECT doc_id FROM documents WHERE {english}",
        "filter_blacklist": f"SELECT doc_id FROM documents WHERE {clean}",
        "dedup_exact": f"SELECT doc_id, source AS source_dataset_name FROM documents QUALIFY {_sha1_first()}",
        "dedup_incremental": f"SELECT doc_id FROM (SELECT * FROM documents WHERE text IS NULL OR sha1(text) NOT IN (SELECT sha1(response) FROM records WHERE response IS NOT NULL)) QUALIFY {_sha1_first()}",
        "filter_chain": f"SELECT doc_id, source AS source_dataset_name FROM (SELECT * FROM documents WHERE {in_range} AND {english} AND {clean}) QUALIFY {_sha1_first()}",
        "filter_counts": f"SELECT source AS source_dataset_name, count(*) AS processed, count(*) FILTER ({in_range}) AS in_range, count(*) FILTER ({in_range} AND {english}) AS in_language, count(*) FILTER ({in_range} AND {english} AND {clean}) AS clean, count(DISTINCT sha1(text)) FILTER ({in_range} AND {english} AND {clean}) AS retained FROM documents GROUP BY 1",
        "sentences": f"WITH {sents} SELECT doc_id, n, sentence, {_tokens('sentence')} AS tokens FROM sents WHERE sentence <> ''",
        "segment_pack": f"WITH RECURSIVE {placed} SELECT doc_id, chunk, min(s) AS start_pos, max(e) AS end_pos FROM walk GROUP BY doc_id, chunk",
        "completion": f"SELECT reply_id, {reply} AS content FROM judge_replies",
        "classify_prompt": _classify_prompt(),
        "classify_parse": f"SELECT reply_id, {genre} AS top FROM (SELECT reply_id, lower({reply}) AS low FROM judge_replies WHERE stage = 'classify')",
        "class_counts": f"WITH {recs} SELECT coalesce(classification.top, 'unknown') AS top, count(*) AS records FROM recs GROUP BY 1",
        "quota_sample": f"WITH {recs} SELECT id, top FROM (SELECT id, coalesce(classification.top, 'unknown') AS top FROM recs) QUALIFY row_number() OVER (PARTITION BY top ORDER BY sha256('0' || id), id) <= {quota}",
        "prompt_gate": f"WITH {recs} SELECT id FROM recs WHERE coalesce(length(prompt), 0) = 0 AND length(response) > 0 AND {_tokens('response')} <= 150",
        "prompt_truncate": "SELECT doc_id, CASE WHEN length(text) > 256 THEN regexp_replace(substr(text, 1, 256), '(?s) [^ ]*\\z', '') || '...' ELSE text END AS prompt FROM documents",
        "prompt_tag": f"WITH {recs}, n AS (SELECT *, CASE WHEN coalesce(length(prompt), 0) = 0 AND length(response) > 0 AND {_tokens('response')} <= 150 THEN substr(response, 1, 400) END AS sug FROM recs) SELECT id, CASE WHEN length(prompt) > 0 THEN prompt WHEN sug IS NOT NULL THEN CASE WHEN length(sug) > 256 THEN regexp_replace(substr(sug, 1, 256), '(?s) [^ ]*\\z', '') || '...' ELSE sug END ELSE prompt END AS prompt, CASE WHEN sug IS NOT NULL THEN 'reconstructed' ELSE meta.prompt_type END AS prompt_type FROM n",
        "route_rubric": f"WITH {recs} SELECT id, {rubric} AS rubric FROM (SELECT id, coalesce(classification.top, 'unknown') AS t FROM recs)",
        "resume_pending": f"WITH {recs} SELECT id FROM recs WHERE id NOT IN (SELECT record_id FROM judge_replies WHERE record_id IS NOT NULL)",
        "resume_labels": f"WITH {recs} SELECT id FROM recs WHERE classification.top IS NULL OR id NOT IN (SELECT record_id FROM judge_replies WHERE stage = 'classify' AND record_id IS NOT NULL)",
        "resume_scores": f"WITH {recs} SELECT id FROM recs WHERE coalesce(cardinality(scores), 0) = 0 AND id NOT IN (SELECT record_id FROM judge_replies WHERE stage = 'score' AND record_id IS NOT NULL)",
        "resume_merge": f"WITH {recs}, c AS (SELECT record_id AS id, {genre} AS label FROM (SELECT record_id, lower({reply}) AS low FROM judge_replies WHERE stage = 'classify' QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY received_at DESC, reply_id DESC) = 1)) SELECT recs.id, coalesce(c.label, classification.top) AS top FROM recs LEFT JOIN c ON c.id = recs.id",
        "metric_percentiles": f"WITH {scores} SELECT metric, n, round(lo, 9) AS lo, round(hi, 9) AS hi, least, most FROM pct",
        "calibrate": f"WITH {scores} SELECT id, sc.metric || '_calibrated' AS metric, round(CASE WHEN hi = lo THEN 0.5 ELSE least(1.0, greatest(0.0, (score - lo) / (hi - lo))) END, 7) AS score FROM sc JOIN pct ON pct.metric = sc.metric WHERE score IS NOT NULL",
        "calibrate_degenerate": f"WITH {scores} SELECT id, sc.metric || '_calibrated' AS metric, 0.5::DOUBLE AS score FROM sc JOIN pct ON pct.metric = sc.metric WHERE score IS NOT NULL",
        "completeness_filter": f"WITH {scores}, {complete} SELECT id FROM best WHERE n / 10.0 >= 0.7",
        "completeness_counts": f"WITH {scores}, {complete} SELECT count(*) AS records, count(*) FILTER (n / 10.0 >= 0.7) AS kept, count(*) FILTER (coalesce(n, 0) / 10.0 < 0.7) AS dropped FROM recs LEFT JOIN best USING (id)",
        "split_assign": f"WITH {recs} SELECT id, {_split('id')} AS split FROM recs",
        "split_report": f"WITH {recs} SELECT split, count(*) AS records, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM (SELECT {_split('id')} AS split FROM recs) GROUP BY split",
        "coverage_gap": f"""WITH {scores}, cells AS (SELECT top, metric, level, 0 AS records FROM (SELECT DISTINCT coalesce(classification.top, 'unknown') AS top FROM recs), (SELECT unnest([{known}]) AS metric), (SELECT unnest(range(1, 6)) AS level)
            UNION ALL SELECT coalesce(classification.top, 'unknown'), metric, greatest(1, least(5, floor(score * 5)::INT + 1)), 1 FROM sc JOIN recs USING (id) WHERE score IS NOT NULL)
            SELECT top, metric, level::INT AS level, sum(records)::BIGINT AS records, greatest(0, 20 - sum(records))::BIGINT AS missing FROM cells GROUP BY 1, 2, 3""",
        "pairs_to_splits": f"WITH {convs}, kept AS (SELECT id FROM (SELECT id, response AS text FROM pairs WHERE {_tokens('response')} BETWEEN 10 AND 2000) QUALIFY {_sha1_first('id')}) SELECT split, count(*) AS records, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM (SELECT {_split('id')} AS split FROM kept) GROUP BY split",
        "pipeline_e2e": f"""WITH RECURSIVE {docs}, {convs}, every AS (SELECT id, NULL::VARCHAR AS prompt, response, 'documents:' || original_id AS key, 0 AS o FROM docs UNION ALL SELECT id, prompt, response, 'conversations:' || original_id, 1 FROM pairs),
            kept AS (SELECT *, {_tokens('response')} AS tokens FROM every WHERE length(response) > 0 AND {_tokens('response')} BETWEEN 10 AND 4000 AND {_english('response')} QUALIFY row_number() OVER (PARTITION BY sha1(response) ORDER BY o, id) = 1),
            {carried.replace('text', 'response').replace('FROM documents WHERE response IS NOT NULL', f'FROM kept WHERE tokens > {CHUNK_TOKENS * 1.1}').replace('doc_id', 'key')},
            cut AS (SELECT 'sha256:' || sha256(key || ':seg:' || chunk) AS id, NULL::VARCHAR AS prompt, max(total) AS tokens FROM walk GROUP BY key, chunk UNION ALL SELECT id, prompt, tokens FROM kept WHERE tokens <= {CHUNK_TOKENS * 1.1}),
            told AS (SELECT *, [{', '.join(map(_quote, _GENRES))}][('0x' || substr(sha256('genre:' || id), 1, 2))::INT % {len(_GENRES)} + 1] AS low FROM cut),
            lab AS (SELECT *, {genre} AS top FROM told QUALIFY row_number() OVER (PARTITION BY {genre} ORDER BY sha256('0' || id), id) <= 5000)
            SELECT split, rubric, count(*) AS records, count(*) FILTER (coalesce(length(prompt), 0) = 0 AND tokens <= 1024) AS reconstructed FROM (SELECT *, {_split('id')} AS split, {rubric.replace('(t,', '(top,').replace(' t =', ' top =')} AS rubric FROM lab) GROUP BY 1, 2""",
    }


def _quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _english(c: str) -> str:
    """At least nine tenths of the words that tell a language, credits included, are English ones."""
    words = f"regexp_extract_all(lower({c}), '\\p{{L}}+')"
    listed = {code: ", ".join(_quote(w) for w in ws) for code, ws in WORDS.items()}
    return f"coalesce((len(list_filter({words}, lambda x: x IN ({listed['en']}))) + 0.03) / (len(list_filter({words}, lambda x: x IN ({', '.join(listed.values())}))) + 0.21) >= 0.9, false)"


# Fixed values, stated a second time: the three prompts as they are sent, with @ where the text stands.
_GENRE = """You are a text classification expert. Your task is to classify the following text into one primary genre category.

Available primary genre categories:

- poetry

- memoir

- review

- unknown

TEXT:
\"\"\"
@
\"\"\"

Based on the text, choose the single most fitting primary genre category from the list above.
If the text is too short, ambiguous, or doesn't clearly fit any category, choose "unknown".

Primary Genre Category:"""
_RECONSTRUCTION = """Given the following assistant's answer, write *one* plausible and concise user prompt that could have realistically produced this answer. The prompt should sound like it was written by a human.

Assistant's Answer:
\"\"\"
@
\"\"\"

User Prompt:"""
_SCORING = """You are an expert literary critic.  
Evaluate the text against each metric and **return a single JSON object** whose
property names are the *metric names* shown below and whose values are the
numeric scores (0.0 – 1.0).  
No prose, no markdown – just the JSON.

TEXT:
\"\"\"
@
\"\"\"

Your task is to score the above text on the following criteria on a 0-1 scale:
%LINES%

---  

Note: if a criterion doesn't apply to the text, omit it from the output.

Return **only** a JSON object like:

{
%SHAPE%
}"""  # noqa: W291
# Fixed values, stated a second time: the metrics of each rubric.
_METRICS = {
    "narrative_creative": "character_authenticity original_premise prose_precision emotional_resonance structural_coherence distinctive_voice thematic_depth sensory_atmosphere natural_dialogue earned_endings",
    "academic_informative": "argumentative_rigor source_credibility conceptual_clarity original_analysis methodological_soundness contextual_awareness evidence_quality accessible_complexity structural_signposting practical_significance",
    "professional": "audience_appropriate actionable_specificity persuasive_logic efficiency_concision strategic_structure credibility_indicators visual_formatting risk_awareness measurable_outcomes call_to_action",
    "entertainment_personal": "authentic_voice engaging_momentum relatable_connection natural_humor vulnerable_boundaries fresh_perspective conversational_clarity multimedia_integration community_engagement memorable_takeaway",
    "adult": "consensual_dynamics psychological_realism sensual_specificity emotional_complexity creative_scenarios tension_building character_driven avoids_stereotypes narrative_integration linguistic_variety",
}
_METRICS["default"] = _METRICS["narrative_creative"]
# Fixed values, stated a second time: the genres in the order in which replies are searched for them.
_GENRES = """story_literary story_adventure story_fantasy story_science_fiction story_horror story_thriller story_mystery story_crime story_romance story_historical story_humor story_young_adult story_children
story_fan_fiction story_other vignette song_lyrics poetry stage_play_script screenplay comic_script videogame_script memoir biography humor_nonfiction academic_article academic_book dissertation_thesis conference_paper
literature_review research_proposal textbook_chapter news_report investigative_journalism how_to_guide popular_science reference_entry medical_info case_study technical_manual editorial column feature_article
profile_interview business_report marketing_copy political_speech advocacy_paper grant_proposal faq_document legal_document product_description website_copy newsletter blog_post diary_entry social_media_post forum_post
youtube_script review interactive_fiction rpg_scenario rpg_transcript travel_writing nature_writing food_writing personal_essay opinion_piece erotic_fiction erotic_roleplay other""".split()
_FLAT = r"\s*\{\s*(?:\"[^\"\\]*\"\s*:\s*(?:-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|\"[^\"\\]*\"|true|false|null)\s*(?:,\s*\"[^\"\\]*\"\s*:\s*(?:-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|\"[^\"\\]*\"|true|false|null)\s*)*)?\}\s*"


def _around(prompt: str, text: str) -> str:
    before, _, after = prompt.partition("@")
    return f"{_quote(before)} || {text} || {_quote(after)}"


def _reconstruction_prompt(recs: str) -> str:
    return f"WITH {recs} SELECT id, sha256({_around(_RECONSTRUCTION, 'response')}) AS prompt_hash FROM recs WHERE coalesce(length(prompt), 0) = 0 AND length(response) > 0 AND {_tokens('response')} <= 1024"


def _score_prompt(recs: str, rubric: str) -> str:
    whens = []
    for name, metrics in _METRICS.items():
        lines, shape = "", ""
        for m in metrics.split():
            lines += f"\n{m} — Rate the text for {m.replace('_', ' ')}. (Hint: {m.replace('_', ' ')})\n"
            shape += f'\n  "{m}": <float between 0.0 and 1.0>{"" if m == metrics.split()[-1] else ","}\n'
        full = _SCORING.replace("%LINES%", lines).replace("%SHAPE%", shape)
        whens.append(f"WHEN '{name}' THEN {_around(full, 'text')}")
    return f"WITH {recs} SELECT id, sha256(CASE rubric {' '.join(whens)} END) AS prompt_hash FROM (SELECT id, coalesce(response, '') AS text, {rubric} AS rubric FROM (SELECT id, response, coalesce(classification.top, 'unknown') AS t FROM recs))"


def _classify_prompt() -> str:
    head = f"coalesce(CASE WHEN {_tokens('text')} > 512 THEN substr(text, 1, 2048) ELSE text END, '')"
    return f"SELECT doc_id, sha256({_around(_GENRE, head)}) AS prompt_hash FROM documents"
