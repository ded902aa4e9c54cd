"""SQL for each registered query that SQL can express."""

from __future__ import annotations

from ladewerk.plans import oracles as O
from ladewerk.plans import queries as Q

_EXAMPLES = O.generated(Q.SEED)
_PREP = O.prepared(Q.SEED, 2.5, 15.0)
_VERSIONED = "(SELECT *, 'v1' AS version FROM judged)"
_RANK = "ORDER BY pct_correct DESC, pct_fields DESC, model_name, version"


def _flag_count(condition: str, name: str) -> str:
    return f"count(DISTINCT CASE WHEN {condition} THEN id END) AS {name}"


def _loaded(plan: str, auto_review: bool) -> str:
    corrected = "CASE WHEN any_value(kind) IS NOT NULL THEN any_value(gold_json) END" if auto_review else "NULL::VARCHAR"
    return O._with(
        f"{O.CONF},{plan},{O._corrupted('plan')}",
        f"""SELECT id + 1 AS id, {O._list_json()} AS parsed, {corrected} AS corrected,
        {'true' if auto_review else 'false'} AS is_reviewed, false AS exclude
        FROM bad_lines JOIN gold USING (id) GROUP BY id""",
    )


def _breakdown(source: str) -> str:
    return f"""SELECT model_name, category, n FROM (
      SELECT model_name, coalesce(category, 'OTHER') AS category, count(*) AS n FROM {source} GROUP BY ALL)
    WHERE list_contains({O._ORDER}, category) ORDER BY model_name, list_position({O._ORDER}, category)"""


_PRED_LISTS = f"""
pred_lists AS (SELECT id, model_name, {O._list_json()} AS predicted FROM pred_lines GROUP BY ALL),
texts AS (SELECT id, text FROM conf_texts)"""
_PREDICTED_TEXT = f"{O.PRED},{O.CONF_TEXT[len(O.CONF) + 1:]}"

# The guard, line by line: a reference that its text lacks is dropped.
_GUARDED = f"""{_PREDICTED_TEXT},
guarded_lines AS (
  SELECT *, {O.LINE_JSON} AS glj FROM (
    SELECT l.* EXCLUDE (lj) REPLACE (CASE WHEN contains(t.text, l.reference) THEN l.reference END AS reference),
      l.reference IS NOT NULL AND NOT contains(t.text, l.reference) AS fired
    FROM pred_lines l JOIN conf_texts t USING (id))),
heads AS (SELECT id, model_name FROM kinds WHERE kind <> 'error')"""

_LABELS = O._list_json()

_EXTERNAL = f"""{O.CONF_TEXT}
SELECT id,
  CASE WHEN NOT contains(text, 'ref ') THEN '[{{"quantity": ' || (1 + length(text) - length(replace(text, chr(10), '')))
    || ', "unit": "pallets", "leg": "pickup", "rate": 1.5}}]' END AS parsed_json,
  CASE WHEN NOT contains(text, 'ref ') THEN true END AS reference_guarded,
  CASE WHEN contains(text, 'ref ') THEN 'ValueError: a reference is stated' END AS error
FROM conf_texts"""

_RETRAIN_ORDER = f"('0x' || substr(md5('{Q.SEED}||' || id || '|order'), 1, 15))::BIGINT"

_STEPS = ", ".join(f"({i}, {O._q(m)})" for i, m in enumerate(Q.CANDIDATES))

ORACLES: dict[str, str] = {
    "gate_report": O._with(O.SCORED, f"{O._gate(_VERSIONED)} {_RANK}"),
    "gate_winner": O._with(O.SCORED, f"{O._gate(_VERSIONED)} {_RANK} LIMIT 1"),
    "gate_from_store": O._with(O.SCORED, f"{O._gate(_VERSIONED)} {_RANK}"),
    "gate_event_log": O._with(O.EVENT_LOG, f"{O._gate('log')} {_RANK}"),
    "breakdown_event_log": O._with(O.EVENT_LOG, _breakdown("log")),
    "score_rows": O._with(
        O.SCORED,
        "SELECT id::VARCHAR AS id, model_name, category, field_accuracy, "
        "category IN ('CORRECT', 'UNORDERED') AS accurate FROM judged",
    ),
    "score_attached_gold": O._with(
        O.SCORED, "SELECT id::VARCHAR AS id, model_name, category, field_accuracy FROM judged"
    ),
    "score_json_text": O._with(
        O.SCORED,
        "SELECT id::VARCHAR AS id, model_name, category, field_accuracy FROM judged",
    ),
    "category_breakdown": O._with(O.SCORED, _breakdown("judged")),
    "outcome_counts": O._with(
        O.SCORED,
        """SELECT model_name, version, count(*) FILTER (category = 'CORRECT') AS n_correct,
        count(*) FILTER (category = 'ERROR') AS n_error, count(*) AS n
        FROM (SELECT *, 'v1' AS version FROM judged) GROUP BY ALL""",
    ),
    "gate_decisions": O._with(O.SCORED, O._decision(Q.DECISIONS)),
    "canonical_json": O._with(O.CONF, "SELECT id, gold_json AS parsed_json FROM gold"),
    "decode_items": O._with(O.CONF, "SELECT id, gold_json AS parsed_json FROM gold"),
    "message_text": O._with(O.CONF_TEXT, "SELECT id, text FROM conf_texts"),
    "validate_labels": O._with(
        O.REVIEWS,
        f"""SELECT id, id % 11 <> 0 AS valid,
        CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN {O._q(O._LAX_CANONICAL)} ELSE parsed END AS canonical
        FROM reviews""",
    ),
    "review_row_validity": O._with(O.REVIEWS, "SELECT id, id % 11 <> 0 AS valid FROM reviews"),
    "reference_guard": O._with(
        _GUARDED,
        f"""SELECT id::BIGINT::VARCHAR AS id, model_name, {O._list_json(value='glj')} AS guarded, coalesce(bool_or(fired), false) AS fired
        FROM heads LEFT JOIN guarded_lines USING (id, model_name) GROUP BY id, model_name""",
    ),
    "label_rules": O._with(
        _GUARDED,
        f"""SELECT model_name, count(DISTINCT id) AS n,
        {_flag_count("kind = 'broken' AND i = 0", 'outside_vocabulary')},
        {_flag_count('pickup_month IS NULL AND (pickup_day IS NOT NULL OR pickup_year IS NOT NULL)', 'bad_date_ladder')},
        {_flag_count('fired', 'unsupported_reference')},
        {_flag_count('n_refs > 1', 'several_references')}
        FROM (SELECT h.id, h.model_name, l.kind, l.i, l.pickup_day, l.pickup_month, l.pickup_year, l.fired, r.n_refs
              FROM (SELECT id, model_name FROM kinds WHERE kind <> 'error') h
              LEFT JOIN guarded_lines l USING (id, model_name)
              LEFT JOIN (SELECT id, model_name, count(DISTINCT coalesce(reference, '')) AS n_refs
                         FROM pred_lines GROUP BY ALL) r USING (id, model_name))
        GROUP BY model_name""",
    ),
    "prompts": f"""SELECT conv_id, turn, {O._prompt('text', 'hint')} AS prompt FROM (
        SELECT *, CASE turn % 3 WHEN 0 THEN 'there are ' || turn || CASE WHEN turn = 1 THEN ' shipment' ELSE ' shipments' END
                  || ' in this message' WHEN 1 THEN role END AS hint FROM conversations)""",
    "trusted_export": O._with(
        O.REVIEWS, "SELECT id::VARCHAR AS id, text, chosen AS parsed_json FROM trusted WHERE chosen IS NOT NULL"
    ),
    "export_round_trip": O._with(
        O.REVIEWS, "SELECT id::VARCHAR AS id, text, chosen AS parsed_json FROM trusted WHERE chosen IS NOT NULL"
    ),
    "trusted_export_counts": O._with(
        O.REVIEWS, "SELECT count(chosen) AS written, count(*) - count(chosen) AS skipped FROM trusted"
    ),
    "trusted_document_labels": "SELECT doc_id AS id FROM labels WHERE quality = 1 AND toxic = 0",
    "review_queue": O._with(
        O.REVIEWS,
        f"""SELECT id, {O._PREVIEW.format(t='text')} AS short_text, reviewed IS NOT NULL AS is_reviewed,
        corrected IS NOT NULL AS has_correction, exclude FROM reviews""",
    ),
    "review_queue_filtered": O._with(
        O.REVIEWS,
        f"SELECT id, {O._PREVIEW.format(t='text')} AS short_text FROM trusted WHERE corrected IS NOT NULL",
    ),
    "review_search": O._with(
        O.REVIEWS,
        f"""SELECT id, {O._PREVIEW.format(t='text')} AS short_text FROM reviews
        WHERE text ILIKE '%run sheet%' AND text ILIKE '%kestrel%' AND corrected IS NULL""",
    ),
    "chat_search": f"""SELECT conv_id, turn, {O._PREVIEW.format(t='text')} AS short_text FROM conversations
        WHERE contains(lower(text), 'the') AND contains(lower(text), 're')""",
    "next_unreviewed": """WITH todo AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus NOT IN ('F', 'P')),
        marks AS (SELECT 'middle' AS "after", floor(avg(o_orderkey)) AS mark FROM orders
                  UNION ALL SELECT 'end', max(o_orderkey) FROM orders)
        SELECT "after", coalesce((SELECT min(id) FROM todo WHERE id > mark), (SELECT min(id) FROM todo)) AS next_id FROM marks""",
    "review_load": _loaded(O.FIRST_PLAN, False),
    "review_load_reviewed": _loaded(O.FIRST_PLAN, True),
    "review_load_plan": O._with(f"{O.CONF},{O.FIRST_PLAN}", "SELECT id AS row_idx, kind FROM plan"),
    "review_load_fraction": _loaded(O.fraction_plan(Q.FRACTION_PERMILLE, Q.SEED), True),
    "review_load_report": O._with(
        f"{O.CONF},{O.fraction_plan(Q.FRACTION_PERMILLE, Q.SEED)}",
        "SELECT kind, count(*) AS n FROM gold LEFT JOIN plan USING (id) GROUP BY kind",
    ),
    "label_audit": O._with(
        f"{O.CONF_TEXT},{O.fraction_plan(Q.FRACTION_PERMILLE, Q.SEED)},{O._corrupted('plan')},{O._error_class()}",
        f"""SELECT id, any_value(error_class) AS error_class, bool_or(unsupported) AS unsupported_reference,
        {O._list_json(value='glj')} AS guarded FROM (
          SELECT *, {O.LINE_JSON} AS glj FROM (
            SELECT b.* EXCLUDE (lj) REPLACE (CASE WHEN contains(t.text, b.reference) THEN b.reference END AS reference),
              coalesce(NOT contains(t.text, b.reference), false) AS unsupported
            FROM bad_lines b JOIN conf_texts t USING (id))) JOIN classes USING (id) GROUP BY id""",
    ),
    "synth_generate": O._with(_EXAMPLES, "SELECT id, text, parsed_json, style, complexity FROM examples"),
    "synth_export": O._with(_EXAMPLES, "SELECT id, text, parsed_json, style FROM examples ORDER BY id"),
    "synth_store_round_trip": O._with(_EXAMPLES, "SELECT id, text, parsed_json, style FROM examples"),
    "synth_sample": O._with(
        _EXAMPLES, "SELECT id, text, parsed_json, style, complexity FROM examples ORDER BY id LIMIT 25"
    ),
    "synth_difficulty": O._with(
        _EXAMPLES, "SELECT style, complexity, count(*) AS n FROM examples GROUP BY ALL"
    ),
    "synth_invariants": """SELECT count(*) AS n, 0::BIGINT AS bad_date_ladder, 0::BIGINT AS unsupported_reference,
        0::BIGINT AS several_references, 0::BIGINT AS outside_vocabulary, 0::BIGINT AS wrong_line_count FROM orders""",
    "train_set": O._with(
        _PREP,
        f"SELECT {O._q(O.INSTRUCTION)} AS instruction, text AS input, parsed_json AS output FROM split WHERE NOT held",
    ),
    "dataset_folder": O._with(_PREP, "SELECT id, text, parsed_json AS expected FROM split WHERE held"),
    "parse_batch": O._with(
        O.CONF,
        """SELECT id, CASE id % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'view' WHEN 2 THEN 'ghost' ELSE 'newer' END AS requested_model,
        CASE id % 5 WHEN 0 THEN 'click' ELSE 'newer' END AS effective_model, id % 5 IN (1, 2) AS fell_back,
        gold_json AS parsed_json, false AS reference_guarded, NULL::VARCHAR AS error FROM gold""",
    ),
    "benchmark_set": O._with(_PREP, "SELECT id, text, parsed_json AS expected FROM split WHERE held"),
    "prep_summary": O._with(
        _PREP,
        """SELECT count(*) FILTER (is_real) AS real, count(*) FILTER (NOT is_real) AS synthetic_used,
        count(*) FILTER (NOT held) AS train, count(*) FILTER (held) AS benchmark FROM split""",
    ),
    # At four synthetic rows to one real row every document is used.
    "retrain_set": O._with(
        _PREP,
        f"""SELECT {O._q(O.INSTRUCTION)} AS instruction, text AS input, parsed_json AS output FROM (
          SELECT text, parsed_json FROM labelled, counts WHERE is_real
          UNION ALL SELECT text, parsed_json FROM ranked_syn, counts WHERE rk <= n_real * 4) l
        WHERE NOT EXISTS (SELECT 1 FROM split s WHERE held AND s.text = l.text)""",
    ),
    "capped_train_set": O._with(
        _PREP,
        f"SELECT {O._q(O.INSTRUCTION)} AS instruction, text AS input, parsed_json AS output FROM shuffled WHERE rk <= 100",
    ),
    "contamination_left": O._with(
        _PREP,
        """SELECT count(*) AS kept, count(DISTINCT text) AS kept_texts FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM split s WHERE held AND s.text = d.text)""",
    ),
    "sft_rows": O._with(
        _PREP,
        f"""SELECT {O._prompt('text', 'hint')} AS prompt, '{{"items": ' || parsed_json || '}}' AS completion FROM (
          SELECT *, CASE WHEN n_lines > 1 OR {O._chance(O._draw('h', 0), 350)} THEN 'there are ' || n_lines
            || CASE WHEN n_lines = 1 THEN ' shipment' ELSE ' shipments' END || ' in this message' END AS hint
          FROM (SELECT *, sha256('{Q.SEED}|' || text || '|hint') AS h FROM split WHERE NOT held))""",
    ),
    "extract_full": O._with(
        _EXAMPLES,
        "SELECT id, parsed_json, false AS reference_guarded, NULL::VARCHAR AS error FROM examples",
    ),
    "extract_confirmations": O._with(O.CONF, "SELECT id, gold_json AS parsed_json FROM gold"),
    "extract_external": O._with(_EXTERNAL, ""),
    "parse_requests": """SELECT event_id, requested_model,
        CASE WHEN requested_model IN ('click', 'newer') THEN requested_model ELSE 'newer' END AS effective_model,
        requested_model NOT IN ('click', 'newer') AS fell_back
        FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'newer' ELSE event_type END
              AS requested_model FROM events)""",
    # A candidate is right where its lines, written canonically, are the held-out label.
    "retrain_cycle": O._with(
        f"""{_PREDICTED_TEXT},{O.REVIEWS[len(O.CONF_TEXT) + 1:]},{_PRED_LISTS},
        pool AS (SELECT id, text, chosen AS label FROM trusted WHERE chosen IS NOT NULL),
        cut AS (SELECT *, row_number() OVER (ORDER BY {_RETRAIN_ORDER}) <= greatest(1, round_even((count(*) OVER ()) * 0.2::DOUBLE, 0)) AS held FROM pool),
        sizes AS (SELECT count(*) FILTER (held) AS n_benchmark,
          count(*) FILTER (NOT EXISTS (SELECT 1 FROM cut h WHERE h.held AND h.text = cut.text)) AS n_train FROM cut),
        answers AS (SELECT k.model_name, k.kind NOT IN ('error', 'broken') AND coalesce(p.predicted, '[]') = c.label AS ok
          FROM cut c JOIN kinds k USING (id) LEFT JOIN pred_lists p USING (id, model_name) WHERE c.held),
        steps AS (SELECT v.step, v.model, 100.0::DOUBLE * count(*) FILTER (ok) / count(*) AS pct
          FROM answers JOIN (VALUES {_STEPS}) v(step, model) ON v.model = model_name GROUP BY ALL),
        ruled AS (SELECT *, max(pct) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM steps)""",
        """SELECT step::INT AS step, model, CASE WHEN best IS NULL THEN 'PROMOTED_BASELINE' WHEN pct > best THEN 'PROMOTED' ELSE 'KEPT' END AS decision,
        round(pct, 6) AS candidate_pct, round(best, 6) AS incumbent_pct, n_train, n_benchmark FROM ruled, sizes""",
    ),
    "seed_file_load": O._with(
        f"{O.CONF_TEXT},{O.FIRST_PLAN},{O._corrupted('plan')},ranks AS (SELECT id, row_number() OVER (ORDER BY id) AS rk FROM gold)",
        f"""SELECT any_value(rk) AS id, any_value(t.text) AS text, {O._list_json(value='b.lj')} AS parsed,
        CASE WHEN any_value(b.kind) IS NOT NULL THEN any_value(gold_json) END AS corrected, true AS is_reviewed, false AS exclude
        FROM bad_lines b JOIN gold USING (id) JOIN ranks USING (id) JOIN conf_texts t USING (id) GROUP BY id""",
    ),
    "gate_from_files": O._with(O.SCORED, f"{O._gate(_VERSIONED)} {_RANK}"),
    "breakdown_from_files": O._with(O.SCORED, _breakdown("judged")),
    "pool_sources": O._with(
        _PREP, "SELECT CASE WHEN is_real THEN 'real' ELSE 'synthetic' END AS source, count(*) AS n, count(DISTINCT id) AS n_ids FROM shuffled GROUP BY ALL"
    ),
    "indexed_search": O._with(
        O.CONF_TEXT,
        f"SELECT id, {O._PREVIEW.format(t='text')} AS short_text FROM conf_texts WHERE text ILIKE '%po-117%' AND text ILIKE '%movers%'",
    ),
    "score_bucketed_gold": O._with(
        O.SCORED, "SELECT id::VARCHAR AS id, model_name, category, field_accuracy FROM judged"
    ),
    "seeded_export": O._with(_PREP, "SELECT rk - 1 AS row_idx, id, text FROM shuffled"),
    "synth_count": "SELECT count(*) AS written, count(*) AS n FROM orders",
}
