"""DuckDB SQL for each report, written from the meaning and not from the Spark plans.

Distances are compared inside whole regions, ranks are plain window ranks, every region
set is counted from its own visits, and walks run densely over all vertices.
"""

from __future__ import annotations

from wayfare.plans import report as R
from wayfare.sources.driver_tables import FIRST_PERSON_ID as FIRST_PERSON

_BASE = {
    "ev": "select event_id, user_id, ts, cast(json_extract(props, '$.k') as bigint) k from events",
    "visits": """select event_id, 100000 + user_id person_id, k // 34 region_id, ts "timestamp",
        55.0::double + (k // 10)::double * 0.0018::double + ((event_id % 7) - 3)::double * 0.0003::double latitude,
        37.0::double + (k % 10)::double * 0.0025::double + ((event_id % 5) - 2)::double * 0.0006::double longitude
        from ev""",
    "places": """select distinct 40 + k id, k // 34 region_id, k % 5 category_id, 'place-' || k "name",
        55.0::double + (k // 10)::double * 0.0018::double latitude,
        37.0::double + (k % 10)::double * 0.0025::double longitude from ev""",
    "persons": "select distinct 100000 + user_id id, user_id % 3 home_region_id from ev",
    "categories": "select distinct category_id, 'category-' || category_id category from places",
    "regions": """select region_id id, min(latitude) lat_lo, max(latitude) lat_hi, min(longitude) lon_lo,
        max(longitude) lon_hi from places group by 1""",
    "requests": """select id person_id, case when (id - 100000) % 2 <> 0 then (id - 100000 + 1) % 3 end region_id
        from persons union all select 999999, null""",
    "candidates": """select p_partkey id, p_partkey % 6 region_id, p_name "name",
        55.0::double + (p_partkey % 17)::double * 0.0004::double latitude,
        37.0::double + (p_partkey % 13)::double * 0.0006::double longitude from part""",
    "confirmed": "select * from candidates where id % 41 = 0 and region_id <> 5",
    "recent": """select * from visits where "timestamp" >= (select max("timestamp") from visits) - interval 7 day""",
    "resolved": """select person_id, home_region_id, target_region_id, {set_key} region_set from (
        select r.person_id, p.home_region_id, coalesce(r.region_id, p.home_region_id) target_region_id,
        p.home_region_id a, coalesce(r.region_id, p.home_region_id) b
        from requests r join persons p on r.person_id = p.id)""",
    "all_sets": """select {set_key} region_set, unnest(list_distinct([a, b])) region_id from
        (select x.id a, y.id b from regions x join regions y on x.id <= y.id)""",
    "asked_sets": "select distinct s.* from all_sets s semi join resolved r on s.region_set = r.region_set",
}
_SET_KEY = "'region' || least(a, b) || case when a <> b then '_region' || greatest(a, b) else '' end"
_BASE = {name: sql.replace("{set_key}", _SET_KEY) for name, sql in _BASE.items()}


def _metres(a: str, b: str) -> str:
    return f"""2 * 6371000.0::double * asin(sqrt(least(1.0::double, pow(sin(radians({b}.latitude - {a}.latitude) / 2), 2)
        + cos(radians({a}.latitude)) * cos(radians({b}.latitude))
        * pow(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"""


def _place_visits(visits: str) -> str:
    return f"""select v.person_id, v."timestamp", p.id place_id, v.region_id, p.category_id
        from {visits} v join places p on v.region_id = p.region_id where {_metres("v", "p")} <= 100"""


_BASE["pv"] = _place_visits("recent")
_BASE["pv_all"] = _place_visits("visits")
_BASE["pv_sets"] = "select s.region_set, pv.* from pv join all_sets s using (region_id)"
_BASE["pv_all_sets"] = "select s.region_set, p.* from pv_all p join all_sets s using (region_id)"
_BASE["pv_asked"] = "select s.region_set, pv.* from pv join asked_sets s using (region_id)"


def _with_used(body: str, steps: dict[str, str] | None = None) -> str:
    """Only the tables that the statement needs."""
    tables = {**_BASE, **(steps or {})}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in sql).split())
        for name in tables:
            if name in words and name not in needed:
                needed.add(name)
                visit(tables[name])

    visit(body)
    parts = [f"{name} as materialized ({sql})" for name, sql in tables.items() if name in needed]
    return "with " + ",\n".join(parts) + "\n" + body


def _text(column: str) -> str:
    return f"""strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"""


def _rated(source: str, entity: str, n: int, value: str = "rating", keys: str = "") -> str:
    by = f"{keys}person_id"
    return f"""select {by}, {entity}, c {value} from (select *, rank() over (partition by {by} order by c desc) rk
        from (select {by}, {entity}, count(*) c from {source} group by {by}, {entity})) where rk <= {n}"""


def _shares(counts: str, source: str, target: str, n: int, keys: str = "") -> str:
    by = f"{keys}{source}"
    return f"""select {keys}{source} source_id, {target} target_id, c / sum(c) over (partition by {by}) weight
        from (select *, rank() over (partition by {by} order by c desc) rk from ({counts})) where rk <= {n}"""


def _counts(source: str, a: str, b: str, keys: str = "") -> str:
    return f"select {keys}{a}, {b}, count(*)::double c from {source} group by {keys}{a}, {b}"


def _covisits(source: str, days: int, keys: str = "") -> str:
    same_set = " and x.region_set = y.region_set" if keys else ""
    key = "x.region_set, " if keys else ""
    return f"""select {key}x.place_id, y.place_id that_id, count(*)::double c from {source} x join {source} y
        on x.person_id = y.person_id{same_set} and x.place_id <> y.place_id
        where abs(epoch_ms(x."timestamp") - epoch_ms(y."timestamp")) <= {days} * 86400000
        group by {key}x.place_id, y.place_id"""


def _graph(source: str) -> str:
    k = "region_set, "
    return f"""select region_set, source_id, target_id, weight * 1.0::double balanced_weight
            from ({_shares(_covisits(source, 7, k), "place_id", "that_id", 50, k)})
        union all select region_set, source_id, target_id, weight
            from ({_shares(_counts(source, "category_id", "place_id", k), "category_id", "place_id", 100, k)})
        union all select region_set, source_id, target_id, weight * 0.5::double
            from ({_shares(_counts(source, "person_id", "place_id", k), "person_id", "place_id", 100, k)})
        union all select region_set, source_id, target_id, weight * 0.5::double
            from ({_shares(_counts(source, "person_id", "category_id", k), "person_id", "category_id", 100, k)})"""


def _walk(steps: int, epsilon: float) -> dict[str, str]:
    """Tables of a dense walk: ``walked`` (set, seed, id, p) and ``taken`` (set, seed, steps)."""
    tables = {
        "graph": _graph("pv_asked"),
        "vertices": """select region_set, source_id id from graph union select region_set, target_id from graph""",
        "dense": """select v.region_set, s.person_id seed, v.id from
            (select distinct r.region_set, r.person_id from resolved r
             semi join vertices w on r.region_set = w.region_set and r.person_id = w.id) s
            join vertices v using (region_set)""",
        "x0": """select region_set, seed, d.id, 1.0::double / n p from dense d
            join (select region_set, count(*) n from vertices group by 1) using (region_set)""",
    }
    for t in range(1, steps + 1):
        tables[f"x{t}"] = f"""select d.region_set, d.seed, d.id,
            case when d.id = d.seed then 0.15::double else 0.0::double end + 0.85::double * coalesce(g.sigma, 0) p
            from dense d left join (select x.region_set, x.seed, e.target_id id, sum(x.p * e.balanced_weight) sigma
                from x{t - 1} x join graph e on x.region_set = e.region_set and x.id = e.source_id
                where x.p > 0 group by 1, 2, 3) g using (region_set, seed, id)"""
    moves = "\nunion all ".join(
        f"""select a.region_set, a.seed, {t} steps, sum(pow(a.p - b.p, 2)) moved
            from x{t} a join x{t - 1} b using (region_set, seed, id) group by 1, 2"""
        for t in range(1, steps + 1)
    )
    close = f"moved <= {epsilon}::double * {epsilon}::double" if epsilon > 0 else "false"
    tables["moves"] = moves
    tables["taken"] = f"""select region_set, seed, coalesce(min(case when {close} then steps end), {steps}) steps
        from moves group by 1, 2"""
    tables["walked"] = "\nunion all ".join(
        f"select x.* from x{t} x join taken using (region_set, seed) where steps = {t} and x.id <> x.seed and p > 0"
        for t in range(1, steps + 1)
    )
    return tables


def _neighbours() -> dict[str, str]:
    k = "region_set, "
    tables = {
        "pr": _rated("pv_asked", "place_id", R.MAX_RATED_PLACES, keys=k),
        "cr": _rated("pv_asked", "category_id", R.MAX_RATED_CATEGORIES, keys=k),
        "targets": """select distinct region_set, person_id from resolved r
            where exists (from pr where pr.region_set = r.region_set and pr.person_id = r.person_id)
            and exists (from cr where cr.region_set = r.region_set and cr.person_id = r.person_id)""",
    }
    for name, rated, entity in (("ps", "pr", "place_id"), ("cs", "cr", "category_id")):
        tables[f"{rated}_n"] = f"select region_set, person_id, sqrt(sum(rating * rating)) n from {rated} group by 1, 2"
        tables[name] = f"""select * from (select d.region_set, d.target_id, d.person_id, d.dot / (a.n * b.n) s from
            (select x.region_set, x.person_id target_id, y.person_id, sum(x.rating * y.rating)::double dot
             from {rated} x join {rated} y on x.region_set = y.region_set and x.{entity} = y.{entity}
             and x.person_id <> y.person_id
             semi join targets t on x.region_set = t.region_set and x.person_id = t.person_id group by 1, 2, 3) d
            join {rated}_n a on a.region_set = d.region_set and a.person_id = d.target_id
            join {rated}_n b on b.region_set = d.region_set and b.person_id = d.person_id) where s > 0"""
    tables["sims"] = f"""select region_set, target_id, person_id,
        coalesce(ps.s, 0) * {R.PLACE_WEIGHT}::double + coalesce(cs.s, 0) * {R.CATEGORY_WEIGHT}::double similarity
        from ps full join cs using (region_set, target_id, person_id)"""
    tables["nearest"] = f"""select * from (select *, row_number() over (partition by region_set, target_id
        order by floor(similarity * 1e9 + 0.137) desc, person_id) rn from sims) where rn <= {R.K_NEAREST}"""
    tables["estimates"] = """select n.region_set, n.target_id person_id, r.place_id,
        sum(r.rating * n.similarity) / sum(n.similarity) estimated_rating
        from nearest n join pr r on r.region_set = n.region_set and r.person_id = n.person_id group by 1, 2, 3"""
    return tables


def _best(source: str, person: str, place: str, score: str, alias: str, n: int = R.MAX_RECOMMENDATIONS) -> str:
    return f"""select person_id, region_id, id, category_id, "name", round(s + 1.37e-10, 6) {alias} from (
        select r.person_id, p.region_id, p.id, p.category_id, p."name", f.{score} s,
        row_number() over (partition by r.region_set, r.person_id order by floor(f.{score} * 1e9 + 0.137) desc, p.id) rn
        from (select distinct region_set, person_id, target_region_id from resolved) r
        join {source} f on f.region_set = r.region_set and f.{person} = r.person_id
        join places p on p.id = f.{place} and p.region_id = r.target_region_id)
        where rn <= {n}"""


def _near_alike(same_name: str = "levenshtein(lower(c.name), lower(f.name)) <= 5") -> str:
    return f"c.region_id = f.region_id and c.id <> f.id and {_metres('c', 'f')} <= 100 and {same_name}"


def all_oracles() -> dict[str, str]:
    edge_columns = "select source_id, target_id, round(weight, 6) weight from"
    off = """(v.latitude < r.lat_lo or v.latitude > r.lat_hi) latitude_off,
        (v.longitude < r.lon_lo or v.longitude > r.lon_hi) longitude_off"""
    violations = f"""select * from (select v.event_id, v.region_id, {off} from visits v
        join regions r on v.region_id = r.id) where latitude_off or longitude_off"""
    walked = "select region_set, seed person_id, id, round(p + 1.37e-10, 8) probability from walked"
    vectors = """select person_id, (select max({e}) + 1 from rated)::integer size,
        (row_number() over (partition by person_id order by {e}) - 1)::integer "position",
        {e}::integer "index", rating::double "value" from rated"""
    one_set = f"region_set = '{R.STORED_REGION_SET}'"
    rebuilt = f"list_contains(string_split(region_set, '_'), 'region{R.REBUILT_REGION}')"
    sql = {
        "scan_persons": ("select id, home_region_id from persons",),
        "scan_places": (
            """select id, category_id, "name", "name" description, region_id, round(latitude, 6) latitude,
            round(longitude, 6) longitude from places""",
        ),
        "scan_categories": ("select category_id, category from categories",),
        "scan_location_visits": (
            f"""select person_id, region_id, strftime("timestamp", '%Y%m') year_month,
            {_text('"timestamp"')} "timestamp", round(latitude, 6) latitude, round(longitude, 6) longitude
            from visits""",
        ),
        "scan_place_visits": (
            f"""select person_id, {_text('"timestamp"')} "timestamp", place_id, region_id, category_id from pv""",
        ),
        "scan_region_set_graph": (
            f"""select region_set, source_id, target_id, round(balanced_weight, 6) balanced_weight
            from graph where {one_set}""",
            {"graph": _graph("pv_sets")},
        ),
        "scan_region_set_ratings": (
            f"""select region_set, person_id, place_id::integer "index", rating::double "value" from rated
            where {one_set}""",
            {"rated": _rated("pv_sets", "place_id", R.MAX_RATED_PLACES, keys="region_set, ")},
        ),
        "scan_factored_graphs": (
            "select region_set, source_id, target_id, round(balanced_weight, 6) balanced_weight from graph",
            {"graph": _graph("pv_sets")},
        ),
        "scan_rebuilt_graphs": (
            f"""select region_set, source_id, target_id, round(balanced_weight * case when {rebuilt} then case
            when source_id < {FIRST_PERSON} then 1 when target_id in (select category_id from categories)
            then {1 - R.REBUILT_PERSON_PLACE}::double / 0.5 else {R.REBUILT_PERSON_PLACE}::double / 0.5 end else 1 end + 1.37e-10, 6)
            balanced_weight from graph""",
            {"graph": _graph("pv_sets")},
        ),
        "scan_rebuilt_category_ratings": (
            f"""select region_set, person_id, category_id::integer "index", rating::double "value" from tight
            where {rebuilt} union all select region_set, person_id, category_id::integer, rating::double from rated
            where not {rebuilt}""",
            {
                "rated": _rated("pv_sets", "category_id", R.MAX_RATED_CATEGORIES, keys="region_set, "),
                "tight": _rated("pv_sets", "category_id", R.TIGHT_TOP_CATEGORIES, keys="region_set, "),
            },
        ),
        "recent_visits": (f"""select event_id, person_id, {_text('"timestamp"')} "timestamp" from recent""",),
        "place_visits_last_week": (
            f"""select person_id, {_text('"timestamp"')} "timestamp", place_id, region_id, category_id from pv""",
        ),
        "place_visits_all_days": (
            """select person_id, place_id, region_id, category_id, count(*) visits from pv_all group by all""",
        ),
        "invalid_locations": (
            """select event_id, round(lat, 6) latitude, round(longitude, 6) longitude from (select *, latitude
            + case when event_id % 97 = 0 then 180.0::double else 0.0::double end lat from visits)
            where lat not between -90 and 90 or longitude not between -180 and 180""",
        ),
        "bounding_box_violations": (violations,),
        "bounding_box_violation_counts": (
            f"""select region_id, count(*) filter (latitude_off) latitude_violations,
            count(*) filter (longitude_off) longitude_violations from ({violations}) group by 1""",
        ),
        "visit_summary": (
            f"""select count(*) visits, {_text('min("timestamp")')} first_timestamp,
            {_text('max("timestamp")')} last_timestamp, count(distinct person_id) visitors from pv_all""",
        ),
        "visit_counts_by_region": ("select region_id, count(*) visits from pv_all group by 1",),
        "visit_profile_by_region": (
            """select region_id, count(*) visits, round(min(latitude) + 1.37e-10, 6) min_latitude,
            round(max(latitude) + 1.37e-10, 6) max_latitude, round(avg(latitude) + 1.37e-10, 6) avg_latitude,
            round(min(longitude) + 1.37e-10, 6) min_longitude, round(max(longitude) + 1.37e-10, 6) max_longitude,
            round(avg(longitude) + 1.37e-10, 6) avg_longitude from visits group by 1""",
        ),
        "top_visitors": (
            "select person_id, count(*) visits from pv_all group by 1 order by visits desc, person_id limit 10",
        ),
        "visit_month_counts": (
            """select region_id, strftime("timestamp", '%Y%m') year_month, count(*) visits from visits group by 1, 2""",
        ),
        "place_profile": (
            """select 'total' "level", -1::bigint region_id, -1::bigint category_id, count(*) places from places
            union all select 'region', region_id, -1, count(*) from places group by region_id
            union all select 'category', -1, category_id, count(*) from places group by category_id""",
        ),
        "category_names": (
            """select p.id, c.category_id, c.category, c.category || '-' || p.id "label"
            from places p join categories c on c.category_id = p.category_id""",
        ),
        "place_ratings_topn": (_rated("pv", "place_id", R.TIGHT_TOP_PLACES),),
        "category_ratings_topn": (_rated("pv", "category_id", R.TIGHT_TOP_CATEGORIES),),
        "place_ratings_preset": (_rated("pv", "place_id", 100, "place_rating"),),
        "category_ratings_preset": (_rated("pv", "category_id", 10, "category_rating"),),
        "place_rating_vectors": (
            vectors.format(e="place_id"),
            {"rated": _rated("pv", "place_id", R.MAX_RATED_PLACES)},
        ),
        "category_rating_vectors": (
            vectors.format(e="category_id"),
            {"rated": _rated("pv", "category_id", R.MAX_RATED_CATEGORIES)},
        ),
        "rating_norms": (
            f"""select person_id, round(sqrt(sum(rating * rating)), 6) norm
            from ({_rated("pv", "place_id", R.MAX_RATED_PLACES)}) group by 1""",
        ),
        "region_place_ratings": (_rated("pv_sets", "place_id", R.TIGHT_TOP_PLACES, keys="region_set, "),),
        "region_category_ratings": (_rated("pv_sets", "category_id", R.TIGHT_TOP_CATEGORIES, keys="region_set, "),),
        "edges_person_place": (
            f"""{edge_columns} ({_shares(_counts("pv", "person_id", "place_id"), "person_id", "place_id", 5)})""",
        ),
        "edges_person_category": (
            f"""{edge_columns} ({_shares(_counts("pv", "person_id", "category_id"), "person_id", "category_id", 2)})""",
        ),
        "edges_category_place": (
            f"""{edge_columns} ({_shares(_counts("pv", "category_id", "place_id"), "category_id", "place_id", 5)})""",
        ),
        "edges_place_place": (f"""{edge_columns} ({_shares(_covisits("pv", 7), "place_id", "that_id", 50)})""",),
        "edges_place_place_banded": (
            f"""{edge_columns} ({_shares(_covisits("pv_all", 7), "place_id", "that_id", 50)})""",
        ),
        "covisits_of_heavy_persons": (
            f"""select place_id, that_id that_place_id, c::bigint visit_pairs from ({_covisits("pv_all", 7)})""",
        ),
        "region_set_visits": ("select region_set, count(*) visits from pv_sets group by 1",),
        "region_set_members": ("select region_set, region_id from all_sets",),
        "stochastic_graph": (
            "select region_set, source_id, target_id, round(balanced_weight, 6) balanced_weight from graph",
            {"graph": _graph("pv_sets")},
        ),
        "stochastic_graph_all_days": (
            "select region_set, source_id, target_id, round(balanced_weight, 6) balanced_weight from graph",
            {"graph": _graph("pv_all_sets")},
        ),
        "graph_source_sums": (
            "select region_set, source_id, round(sum(balanced_weight) + 1.37e-10, 6) weight_sum from graph group by 1, 2",
            {"graph": _graph("pv_sets")},
        ),
        "graph_vertices": (
            "select region_set, source_id id from graph union select region_set, target_id from graph",
            {"graph": _graph("pv_sets")},
        ),
        "vertex_id_collisions": (
            """select id, string_agg(kind, ',' order by kind) kinds from (select distinct id, kind from
            (select person_id - 100000 + 40 id, 'person' kind from pv_all union all select place_id, 'place' from pv_all
             union all select category_id, 'category' from pv_all)) group by id having count(*) > 1""",
        ),
        "resolved_requests": ("select person_id, home_region_id, target_region_id, region_set from resolved",),
        "rejected_requests": (
            """select person_id, coalesce(region_id, -1) region_id, 'unknown person' reason from requests
            where person_id not in (select id from persons)""",
        ),
        "requests_outside_graph": (
            """select person_id, home_region_id, target_region_id, region_set, 'person not in graph' reason
            from resolved r anti join vertices v on v.region_set = r.region_set and v.id = r.person_id""",
            _walk(1, 0),
        ),
        "requests_without_ratings": (
            """select person_id, home_region_id, target_region_id, region_set, 'person without ratings' reason
            from resolved r anti join targets t on t.region_set = r.region_set and t.person_id = r.person_id""",
            _neighbours(),
        ),
        "walk_one_step": (walked, _walk(1, 0)),
        "walk_fixed_steps": (walked, _walk(R.FIXED_STEPS, 0)),
        "walk_converged": (walked, _walk(R.SQL_STEPS, R.EPSILON)),
        "walk_steps": (
            "select region_set, seed person_id, steps::bigint steps from taken",
            _walk(R.SQL_STEPS, R.FINE_EPSILON),
        ),
        "walk_recommended_places": (
            _best("walked", "seed", "id", "p", "probability"),
            _walk(R.SQL_STEPS, R.EPSILON),
        ),
        "similar_persons": (
            "select region_set, target_id, person_id, round(similarity, 6) similarity from nearest",
            _neighbours(),
        ),
        "similar_persons_by_bounds": (
            "select region_set, target_id, person_id, round(similarity, 6) similarity from nearest",
            _neighbours(),
        ),
        "similar_persons_large_k": (
            "select region_set, target_id, person_id, round(similarity, 6) similarity from sims",
            _neighbours(),
        ),
        "cosine_pairs": (
            """select region_set, target_id, person_id, round(coalesce(ps.s, 0), 6) place_similarity,
            round(coalesce(cs.s, 0), 6) category_similarity from ps full join cs using (region_set, target_id, person_id)""",
            _neighbours(),
        ),
        "knn_recommended_places_large_n": (
            _best("estimates", "person_id", "place_id", "estimated_rating", "estimated_rating", R.LARGE_N),
            _neighbours(),
        ),
        "knn_estimates": (
            "select region_set, person_id, place_id, round(estimated_rating + 1.37e-10, 6) estimated_rating from estimates",
            _neighbours(),
        ),
        "knn_recommended_places": (
            _best("estimates", "person_id", "place_id", "estimated_rating", "estimated_rating"),
            _neighbours(),
        ),
        "dedup_pairs": (
            f"""select c.id, c.region_id, c."name", count(*) different_places from candidates c join confirmed f
            on c.region_id = f.region_id and c.id <> f.id
            where {_metres("c", "f")} > 100 or levenshtein(lower(c.name), lower(f.name)) > 5 group by 1, 2, 3""",
        ),
        "drop_duplicate_places": (
            f"""select c.id, c.region_id, c."name" from candidates c
            where not exists (select 1 from confirmed f where {_near_alike()})""",
        ),
        "mark_duplicate_places": (
            f"""select id, region_id, "name", coalesce(duplicate_of, -1) duplicate_of,
            round(case when duplicate_of is null then -1.0 else d end, 6)::double duplicate_distance from (
            select c.id, c.region_id, c."name", f.id duplicate_of, {_metres("c", "f")} d,
            row_number() over (partition by c.id order by {_metres("c", "f")}, f.id) rn
            from candidates c left join confirmed f on {_near_alike()}) where rn = 1""",
        ),
    }
    return {name: _with_used(*statement) for name, statement in sql.items()}
