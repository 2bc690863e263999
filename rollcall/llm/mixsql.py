"""The mix of sources as SQL over `documents`, by sorting whole sources: the check of op11."""

from __future__ import annotations

from collections.abc import Sequence


def mix_sql(weights: Sequence[int], limit: int, classes: Sequence[int], seed: str) -> str:
    n = len(classes) + 1
    weight = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights))
    group = " ".join(f"WHEN size * {c} > target THEN {k}" for k, c in enumerate(classes))
    sizes = ", ".join(f"sum(CASE WHEN class = {c} THEN size ELSE 0 END)::BIGINT AS s{c}" for c in range(n))

    def uniform(parts: str) -> str:
        digits = f"CAST('0x' || substr(md5('{seed}:' || {parts}), 1, 13) AS BIGINT)"
        return f"({digits}::DOUBLE + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE"

    steps, state = "", "state"
    for c in range(n):
        rest = " + ".join(f"s{k}" for k in range(c, n))
        smaller = " + ".join(["0", *[f"s{k}" for k in range(c + 1, n)]])
        draw = uniform(f"'source:' || place || ':{c}'")
        steps += f""", rate{c} AS (
      SELECT *, CASE WHEN {rest} > 0 THEN least({limit}::DOUBLE, greatest(0::DOUBLE, missing / ({rest}))) ELSE 0 END AS rate
      FROM {state}
    ), asked{c} AS (
      SELECT *, rate - floor(rate) AS p, (rate - floor(rate)) * s{c} AS budget, rate * ({smaller}) / 2 AS spare FROM rate{c}
    ), ranked{c} AS (
      SELECT x.*, floor(rate) AS whole, p, budget, spare,
             CASE WHEN p > 0 THEN ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) ELSE 1 END AS v
      FROM placed x JOIN asked{c} USING (place) WHERE class = {c}
    ), upto{c} AS (
      SELECT *, sum(size) OVER (PARTITION BY place ORDER BY v) AS after,
             sum(size) OVER (PARTITION BY place, v) AS here FROM ranked{c}
    ), cut{c} AS (
      SELECT *, next_size * ({draw}) < budget - before AND next_size - (budget - before) <= spare AS crossing
      FROM (SELECT place, any_value(budget) AS budget, any_value(spare) AS spare, min(v) AS cut,
                   arg_min(after - here, v) AS before, arg_min(here, v) AS next_size
            FROM upto{c} WHERE p > 0 AND after > budget GROUP BY place)
    ), drawn{c} AS (
      SELECT r.doc_id, r.source, r.size, r.digest, r.k, r.place, r.source_size, r.target, r.v,
             r.whole + CASE WHEN p = 0 THEN 0 WHEN cut IS NULL OR v < cut OR (crossing AND v = cut) THEN 1 ELSE 0 END AS copies
      FROM ranked{c} r LEFT JOIN cut{c} USING (place)
    ), state{c} AS (
      SELECT a.* EXCLUDE (missing, rate, p, budget, spare), missing - floor(rate) * s{c} - CASE WHEN p = 0 THEN 0
               WHEN cut IS NULL THEN s{c} ELSE before + CASE WHEN crossing THEN next_size ELSE 0 END END AS missing
      FROM asked{c} a LEFT JOIN cut{c} USING (place)
    )"""
        state = f"state{c}"
    union = " UNION ALL ".join(f"SELECT * FROM drawn{c}" for c in range(n))
    return f"""
    WITH counted AS (
      SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
             len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
      FROM documents
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id, digest ORDER BY source) - 1 AS k FROM counted
    ), random AS (
      SELECT *, {uniform("coalesce(doc_id::VARCHAR, 'null') || ':' || digest || ':' || k")} AS u FROM numbered
    ), sources AS (
      SELECT source, source_size, place, (CASE (place - 1) % {len(weights)} {weight} END)::DOUBLE AS weight
      FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM counted GROUP BY source)
    ), levels AS (
      SELECT *, (sum(source_size) OVER () - {limit} * coalesce(sum(source_size) OVER before, 0))::DOUBLE
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
      FROM sources
      WINDOW before AS (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), level AS (
      SELECT arg_min(level, source_size / weight) AS level FROM levels WHERE {limit} * source_size >= level * weight
    ), aims AS (
      SELECT source, source_size, place,
             least({limit}::DOUBLE * source_size, coalesce(level.level * weight, {limit}::DOUBLE * source_size)) AS target
      FROM sources, level
    ), placed AS (
      SELECT doc_id, r.source, size, digest, k, u, place, source_size, target,
             CASE {group} ELSE {len(classes)} END AS class
      FROM random r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source
    ), state AS (
      SELECT place, target, target AS missing, {sizes} FROM placed GROUP BY place, target
    ){steps}, drawn AS ({union}), last AS (
      SELECT place, arg_min({{'digest': digest, 'k': k, 'id': doc_id}},
                            {{'d': abs(missing - size), 'v': v, 'digest': digest, 'k': k, 'id': doc_id}}) AS x
      FROM drawn JOIN {state} USING (place)
      WHERE missing > 0 AND copies < {limit} AND abs(missing - size) < missing GROUP BY place
    )
    SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies
    FROM (SELECT d.* REPLACE (copies + CASE WHEN digest = x.digest AND d.k = x.k AND doc_id IS NOT DISTINCT FROM x.id
                                       THEN 1 ELSE 0 END AS copies)
          FROM drawn d LEFT JOIN last USING (place))
    """
