"""SQL for DuckDB that states each registered query a second time, over the same tables.

Written on its own terms: days in force by a range join with a calendar, latest rows by maxima, exact
medians by the engine itself. Decimals leave as DOUBLE, days and UTC clocks as text, like ``wire``.
"""

from __future__ import annotations

import re

# --- output types ------------------------------------------------------------------------------------

DOUBLES = {
    "prix_litre", "prix_precedent", "variation", "prix_median", "prix_median_autoroute",
    "prix_median_route", "ecart", "prix_actuel", "prix_dernier_changement", "q1", "mediane", "q3",
}
TEXTS = {
    "maj_at", "jour_releve", "jour", "releve_le", "changement_precedent_at", "reference_at",
    "premier_releve_at", "dernier_releve_at", "_loaded_at", "jour_suivant", "local", "utc",
}


def pick(columns: str, source: str) -> str:
    """``SELECT`` with the output types of the contract."""
    items = []
    for name in columns.split():
        if name in DOUBLES:
            items.append(f"CAST({name} AS DOUBLE) AS {name}")
        elif name in TEXTS:
            items.append(f"CAST({name} AS VARCHAR) AS {name}")
        else:
            items.append(name)
    return f"SELECT {', '.join(items)} FROM {source}"


def row_digests(relation: str, columns: str) -> str:
    """The name and a digest of each row: all columns by name, decimals in thousandths, degrees in hundred-thousandths."""
    texts = []
    for name in sorted(columns.split()):
        if name in DOUBLES:
            name = f"CAST({name} * 1000 AS BIGINT)"
        elif name in ("latitude", "longitude"):
            name = f"CAST(round({name} * 100000) AS BIGINT)"
        texts.append(f"coalesce(CAST({name} AS VARCHAR), '~')")
    return f"SELECT '{relation}' AS relation, md5(concat_ws('|', {', '.join(texts)})) AS empreinte FROM {relation}"


# --- raw layer ---------------------------------------------------------------------------------------


def _place(key: str, nation: str) -> str:
    return f"""
        CAST({key} % 100 * 10000 + 4100000 AS VARCHAR) AS latitude,
        CAST({key} % 15 * 100000 - 500000 AS VARCHAR) AS longitude,
        lpad(CAST({nation} % 5 + 1 AS VARCHAR), 2, '0') || '000' AS cp,
        CASE WHEN {key} % 5 = 0 THEN 'A' ELSE 'R' END AS pop"""


def _lineage(year: str, label: str) -> str:
    return f"""
        CAST({year} AS SMALLINT) AS _source_year,
        '{label}_annuel_' || CAST({year} AS VARCHAR) || '_telecharge_20241231.zip' AS _source_file,
        sha256('{label}' || CAST({year} AS VARCHAR)) AS _source_sha256,
        TIMESTAMP '2024-12-31 06:00:00' AS _loaded_at"""


FUEL = """CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'error' THEN '3'
        WHEN 'purchase' THEN '4' WHEN 'signup' THEN '5' END"""
TENTHS = "CAST(floor(value / 50) + 12 AS BIGINT)"
PRICE = f"CAST({TENTHS} // 10 AS VARCHAR) || '.' || CAST({TENTHS} % 10 AS VARCHAR) || '00'"


def hour_text(days: int) -> str:
    return f"strftime(ts + INTERVAL {days} DAY, '%Y-%m-%dT%H:00:00')"


def event_prices(days: int = 0) -> str:
    return f"""
    SELECT CAST(user_id + 1 AS VARCHAR) AS pdv_id, {_place("user_id", "user_id")},
        {FUEL} AS prix_id, event_type AS prix_nom, {hour_text(days)} AS maj, {PRICE} AS valeur,
        {_lineage("2024", "events")}
    FROM events
    UNION ALL
    SELECT CAST(c_custkey + 1 AS VARCHAR), {_place("c_custkey", "c_custkey")},
        NULL, NULL, NULL, NULL, {_lineage("2024", "events")}
    FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)"""


CUSTOMER_STATIONS = f"""
    SELECT CAST(c_custkey + 1 AS VARCHAR) AS pdv_id, {_place("c_custkey", "c_nationkey")},
        c_name || ' ' AS adresse, c_mktsegment AS ville, {_lineage("2024", "events")}
    FROM customer"""

THOUSANDTHS = "CAST(floor(o_totalprice / 100) AS BIGINT)"
ORDER_PRICES = f"""
    SELECT CAST(o_custkey + 1 AS VARCHAR) AS pdv_id, {_place("o_custkey", "o_custkey")},
        left(o_orderpriority, 1) AS prix_id, substr(o_orderpriority, 3) AS prix_nom,
        strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS maj,
        CAST({THOUSANDTHS} // 1000 AS VARCHAR) || '.'
            || lpad(CAST({THOUSANDTHS} % 1000 AS VARCHAR), 3, '0') AS valeur,
        {_lineage("year(o_orderdate)", "orders")}
    FROM orders"""

YEARLY_STATIONS = f"""
    SELECT CAST(c_custkey + 1 AS VARCHAR) AS pdv_id, {_place("c_custkey", "c_nationkey")},
        c_name || ' ' || CAST(y AS VARCHAR) AS adresse, c_mktsegment AS ville,
        {_lineage("y", "orders")}
    FROM customer CROSS JOIN range(1995, 2002) AS years(y)"""

# --- relations ---------------------------------------------------------------------------------------


def utc(clock: str) -> str:
    return f"(timezone('Europe/Paris', {clock}) AT TIME ZONE 'UTC')"


def paris(instant: str) -> str:
    """Local clock of a UTC clock."""
    return f"timezone('Europe/Paris', timezone('UTC', {instant}))"


def suspect(fuel: str = "fuel_id", price: str = "prix_litre") -> str:
    return (
        f"CASE WHEN {fuel} = 3 THEN {price} > 1.50 WHEN {fuel} = 4 THEN {price} > 1.80 ELSE FALSE END"
    )


RELATIONS = {
    "reports": f"""
    SELECT CAST(pdv_id AS INTEGER) AS station_id, CAST(prix_id AS SMALLINT) AS fuel_id,
        prix_nom AS fuel, {utc("CAST(maj AS TIMESTAMP)")} AS maj_at,
        CAST(CAST(maj AS TIMESTAMP) AS DATE) AS jour_releve,
        CAST(valeur AS DECIMAL(8,3)) AS prix_litre,
        _source_year, _source_file, _source_sha256, _loaded_at, pdv_id, prix_id, maj
    FROM raw_prices WHERE prix_id IS NOT NULL""",
    "staged_prices": """
    SELECT any_value(station_id) AS station_id, any_value(fuel_id) AS fuel_id,
        coalesce(arg_max(fuel, prix_litre), max(fuel)) AS fuel,
        any_value(maj_at) AS maj_at,
        any_value(jour_releve) AS jour_releve, max(prix_litre) AS prix_litre,
        max(_source_year) AS _source_year, max(_source_file) AS _source_file,
        max(_loaded_at) AS _loaded_at
    FROM reports GROUP BY pdv_id, prix_id, maj""",
    "staged_stations": """
    SELECT CAST(pdv_id AS INTEGER) AS station_id, trim(adresse) AS adresse, trim(ville) AS ville,
        cp AS code_postal, try_cast(latitude AS DOUBLE) / 100000 AS latitude,
        try_cast(longitude AS DOUBLE) / 100000 AS longitude, pop = 'A' AS est_autoroute,
        _source_year, _source_file, _loaded_at
    FROM raw_stations""",
    "daily": """
    SELECT station_id, fuel_id, fuel, jour_releve AS jour,
        arg_max(prix_litre, maj_at) AS prix_litre
    FROM staged_prices GROUP BY station_id, fuel_id, fuel, jour_releve""",
    "calendar": """
    SELECT CAST(unnest(generate_series(min(jour), max(jour), INTERVAL 1 DAY)) AS DATE) AS jour
    FROM daily""",
    "prices_in_force": f"""
    SELECT d.station_id, d.fuel_id, d.fuel, c.jour, d.prix_litre, d.jour AS releve_le,
        {suspect("d.fuel_id", "d.prix_litre")} AS est_prix_suspect
    FROM daily AS d JOIN calendar AS c ON c.jour >= d.jour AND c.jour <= d.jour + 7
    QUALIFY d.jour = max(d.jour) OVER (PARTITION BY d.station_id, d.fuel_id, c.jour)""",
    "history": """
    SELECT *, lag(prix_litre) OVER p AS avant
    FROM staged_prices WINDOW p AS (PARTITION BY station_id, fuel_id ORDER BY maj_at)""",
    "price_changes": f"""
    SELECT station_id, fuel_id, fuel, maj_at, prix_litre, avant AS prix_precedent,
        prix_litre - avant AS variation, avant IS NULL AS est_premier_releve,
        {suspect()} AS est_prix_suspect,
        max(maj_at) OVER (PARTITION BY station_id, fuel_id ORDER BY maj_at
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS changement_precedent_at
    FROM (SELECT * FROM history WHERE prix_litre IS DISTINCT FROM avant)""",
    "current_prices": f"""
    SELECT s.station_id, s.fuel_id, s.fuel, s.prix_litre, s.maj_at,
        {suspect("s.fuel_id", "s.prix_litre")} AS est_prix_suspect,
        CAST(r.reference_at_local AS DATE) - CAST({paris("s.maj_at")} AS DATE)
            AS nombre_jours_depuis_maj,
        r.reference_at
    FROM staged_prices AS s
    JOIN (SELECT station_id, fuel_id, max(maj_at) AS dernier FROM staged_prices GROUP BY ALL) AS l
      ON l.station_id = s.station_id AND l.fuel_id = s.fuel_id AND l.dernier = s.maj_at
    CROSS JOIN (SELECT max(maj_at) AS reference_at, {paris("max(maj_at)")} AS reference_at_local
                FROM staged_prices) AS r""",
    "stations": """
    SELECT s.station_id, s.adresse, s.ville, s.code_postal, s.latitude, s.longitude, s.est_autoroute,
        a.premier_releve_at, a.dernier_releve_at, a.nombre_fuels, a.nombre_releves,
        s._source_year AS annee_version
    FROM staged_stations AS s
    JOIN (SELECT station_id, max(_source_year) AS derniere, min(maj_at) AS premier_releve_at,
              max(maj_at) AS dernier_releve_at, count(DISTINCT fuel_id) AS nombre_fuels,
              count(*) AS nombre_releves
          FROM staged_prices GROUP BY station_id) AS a
      ON a.station_id = s.station_id AND a.derniere = s._source_year""",
    "usable": """
    SELECT * FROM prices_in_force
    WHERE est_prix_suspect IS FALSE AND jour >= (SELECT min(jour) + 7 FROM daily)""",
    "daily_medians": """
    SELECT jour, fuel_id, fuel, median(prix_litre) AS prix_median,
        count(*) AS nombre_stations
    FROM usable GROUP BY jour, fuel_id, fuel""",
    "by_kind": """
    SELECT u.jour, left(s.code_postal, 2) AS departement, u.fuel_id, u.fuel,
        s.est_autoroute, median(u.prix_litre) AS prix, count(*) AS n
    FROM usable AS u JOIN stations AS s ON s.station_id = u.station_id
    GROUP BY ALL""",
    "motorway_gap": """
    SELECT a.jour, a.departement, a.fuel_id, a.fuel, a.prix AS prix_median_autoroute,
        r.prix AS prix_median_route, a.n AS nombre_stations_autoroute, r.n AS nombre_stations_route,
        a.prix - r.prix AS ecart
    FROM by_kind AS a JOIN by_kind AS r USING (jour, departement, fuel_id, fuel)
    WHERE a.est_autoroute AND NOT r.est_autoroute""",
}

EVENT_LAKE = {"raw_prices": event_prices(), "raw_stations": CUSTOMER_STATIONS}
ORDER_LAKE = {"raw_prices": ORDER_PRICES, "raw_stations": YEARLY_STATIONS}


def lake(query: str, base: dict[str, str] | None = None, **changed: str) -> str:
    """The query with every relation it needs in front. A changed relation may read its own old text
    under the name ``<relation>_0``."""
    texts = {**(base or EVENT_LAKE), **RELATIONS}
    for name, text in changed.items():
        if name in texts:
            texts[f"{name}_0"] = texts[name]
        texts[name] = text
    needed: list[str] = []

    def visit(text: str, skip: str = "") -> None:
        for name in texts:
            if name != skip and name not in needed and re.search(rf"\b{name}\b", text):
                visit(texts[name], name)
                if name not in needed:
                    needed.append(name)

    visit(query)
    ctes = ",\n".join(f"{name} AS ({texts[name]})" for name in needed)
    return f"WITH {ctes}\n{query}" if needed else query


def where(relation: str, condition: str, **values: str) -> str:
    """The old rows of a relation with some columns changed where the condition holds."""
    cases = ", ".join(
        f"CASE WHEN {condition} THEN {value} ELSE {name} END AS {name}" for name, value in values.items()
    )
    return f"SELECT * REPLACE ({cases}) FROM {relation}_0"


# --- queries -----------------------------------------------------------------------------------------

STAGED = (
    "station_id fuel_id fuel maj_at jour_releve prix_litre _source_year _source_file _loaded_at"
)
CHANGES = (
    "station_id fuel_id fuel maj_at prix_litre prix_precedent variation est_premier_releve "
    "est_prix_suspect changement_precedent_at"
)
CURRENT = (
    "station_id fuel_id fuel prix_litre maj_at est_prix_suspect nombre_jours_depuis_maj "
    "reference_at"
)
STATIONS = (
    "station_id adresse ville code_postal latitude longitude est_autoroute premier_releve_at "
    "dernier_releve_at nombre_fuels nombre_releves annee_version"
)
IN_FORCE = "station_id fuel_id fuel jour prix_litre releve_le est_prix_suspect"
MEDIANS = "jour fuel_id fuel prix_median nombre_stations"
GAP = (
    "jour departement fuel_id fuel prix_median_autoroute prix_median_route "
    "nombre_stations_autoroute nombre_stations_route ecart"
)

ARCHIVE = "'lot' || CAST(lot AS VARCHAR) || '_annuel_2024_telecharge_20241231.zip'"
LISTED = f"""
    SELECT DISTINCT event_id // 5000 AS lot, user_id AS c_custkey FROM events
    UNION ALL
    SELECT c_custkey // 5000, c_custkey FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)"""
TAGS = f"""
    SELECT event_id // 5000 AS lot, user_id AS c_custkey, {FUEL} AS prix_id, event_type AS prix_nom,
        {hour_text(0)} AS maj, {PRICE} AS valeur
    FROM events
    UNION ALL
    SELECT c_custkey // 5000, c_custkey, NULL, NULL, NULL, NULL FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)"""
ATTRIBUTES = f"""CAST(c_custkey + 1 AS VARCHAR) AS pdv_id, {_place("c_custkey", "c_nationkey")}"""

MANIFEST = """
    SELECT CAST(o_orderkey // 200 AS INTEGER) AS annee,
        CAST(DATE '2020-01-01' + CAST(o_orderkey % 200 AS INTEGER) AS DATE) AS jour,
        sha256(o_orderstatus || o_orderpriority) AS sha256, CAST(floor(o_totalprice) AS BIGINT) AS octets
    FROM orders"""
KEPT = f"""
    SELECT * FROM (
        SELECT * FROM ({MANIFEST})
        QUALIFY row_number() OVER (PARTITION BY annee, date_trunc('week', jour) ORDER BY jour DESC) = 1)
    QUALIFY row_number() OVER (PARTITION BY annee, sha256 ORDER BY jour DESC) = 1"""

SAMPLE = """
    WITH prices AS ({prices}),
    listed AS (SELECT CAST(c_custkey + 1 AS VARCHAR) AS pdv_id FROM customer),
    ranked AS (
        SELECT pdv_id, priced, rank() OVER (PARTITION BY priced ORDER BY md5(pdv_id)) AS place FROM (
            SELECT l.pdv_id, coalesce(p.years, 0) AS priced FROM listed AS l LEFT JOIN (
                SELECT pdv_id, len(list_distinct(list(_source_year))) AS years FROM prices GROUP BY pdv_id) AS p
            ON p.pdv_id = l.pdv_id))
    SELECT {columns} FROM {source} AS s WHERE s.pdv_id BETWEEN '1' AND '4' AND length(s.pdv_id) = 1
        OR EXISTS (SELECT 1 FROM ranked AS r WHERE r.pdv_id = s.pdv_id
                   AND r.place <= CASE r.priced WHEN 2 THEN 60 WHEN 0 THEN 5 ELSE 0 END)"""


def number(value: str, scale: int) -> str:
    """JSON text of a number: its decimals without trailing zeros, one at least."""
    return (
        f"coalesce(regexp_replace(CAST(CAST({value} AS DECIMAL(28,{scale})) AS VARCHAR), "
        f"'(\\.\\d+?)0+$', '\\1'), 'null')"
    )


def text(value: str) -> str:
    return f"coalesce(CAST(to_json({value}) AS VARCHAR), 'null')"


def stamp(value: str, form: str = "%Y-%m-%dT%H:%M:%SZ") -> str:
    return f"strftime({value}, '{form}')"


STATION_LINES = f"""
    SELECT s.station_id, '[' || s.station_id || ',' || {number("round(s.latitude, 5)", 5)} || ','
        || {number("round(s.longitude, 5)", 5)} || ',' || {text("s.adresse")} || ',' || {text("s.ville")}
        || ',' || {text("s.code_postal")} || ',' || s.est_autoroute || ',['
        || string_agg('[' || p.fuel_id || ',' || {number("p.prix_litre", 3)} || ',"'
            || {stamp("p.maj_at", "%Y-%m-%dT%H:%MZ")} || '",' || p.nombre_jours_depuis_maj || ','
            || p.est_prix_suspect || ']', ',' ORDER BY p.fuel_id)
        || ']]' AS ligne
    FROM stations AS s JOIN current_prices AS p ON p.station_id = s.station_id
    GROUP BY s.station_id, s.latitude, s.longitude, s.adresse, s.ville, s.code_postal, s.est_autoroute"""

MEDIAN_SERIES = f"""
    SELECT fuel_id, '[' || string_agg('["' || jour || '",' || {number("prix_median", 4)} || ','
        || nombre_stations || ']', ',' ORDER BY jour) || ']' AS serie
    FROM daily_medians GROUP BY fuel_id"""

def at_share(share: float) -> str:
    """Value at a share of the sorted gaps ``g``, between its two neighbours."""
    place = f"((len(g) - 1) * {share})"
    low, high = f"g[CAST(floor({place}) AS BIGINT) + 1]", f"g[CAST(ceil({place}) AS BIGINT) + 1]"
    between = f"{low} + ({high} - {low}) * ({place} - floor({place}))"
    return f"trunc(CAST(({between}) * 1000 AS DECIMAL(18,4))) / 1000"


GAP_SUMMARY = f"""
    SELECT fuel_id, CAST({at_share(0.5)} AS DOUBLE) AS ecart_median, CAST({at_share(0.25)} AS DOUBLE) AS ecart_q1,
        CAST({at_share(0.75)} AS DOUBLE) AS ecart_q3,
        round((parts[(len(parts) + 1) // 2] + parts[len(parts) // 2 + 1]) / 2, 4) AS ecart_median_part,
        round(len(list_filter(g, lambda x: x > 0)) / len(g), 4) AS part_cas_autoroute_plus_chere,
        CAST(len(g) AS BIGINT) AS cas, CAST(len(list_distinct(areas)) AS BIGINT) AS departements
    FROM (SELECT fuel_id, list_sort(list(ecart)) AS g, list(departement) AS areas,
              list_sort(list(CAST(ecart AS DOUBLE) / CAST(prix_median_route AS DOUBLE))) AS parts
          FROM motorway_gap GROUP BY fuel_id)"""
GAP_YEARS = """
    SELECT fuel_id, year(jour) AS annee, CAST(median(ecart) AS DOUBLE) AS ecart_median
    FROM motorway_gap GROUP BY fuel_id, year(jour)"""
GAP_DAYS = """
    SELECT fuel_id, jour, CAST(median(ecart) AS DOUBLE) AS ecart_median, count(*) AS departements
    FROM motorway_gap GROUP BY fuel_id, jour"""
GAP_SERIES = f"""
    SELECT s.fuel_id, '{{"ecart_median":' || {number("s.ecart_median", 4)}
        || ',"ecart_q1":' || {number("s.ecart_q1", 4)} || ',"ecart_q3":' || {number("s.ecart_q3", 4)}
        || ',"ecart_median_part":' || {number("s.ecart_median_part", 4)}
        || ',"part_cas_autoroute_plus_chere":' || {number("s.part_cas_autoroute_plus_chere", 4)}
        || ',"cas":' || s.cas || ',"departements":' || s.departements
        || ',"par_annee":{{' || y.annees || '}}}}' AS resume, '[' || d.jours || ']' AS serie
    FROM ({GAP_SUMMARY}) AS s
    JOIN (SELECT fuel_id, string_agg('"' || annee || '":' || {number("ecart_median", 4)}, ','
              ORDER BY annee) AS annees FROM ({GAP_YEARS}) GROUP BY fuel_id) AS y
      ON y.fuel_id = s.fuel_id
    JOIN (SELECT fuel_id, string_agg('["' || jour || '",' || {number("ecart_median", 4)} || ','
              || departements || ']', ',' ORDER BY jour) AS jours FROM ({GAP_DAYS})
          GROUP BY fuel_id) AS d
      ON d.fuel_id = s.fuel_id"""

VOLUMES = f"""
    SELECT (SELECT {stamp("max(reference_at)")} FROM current_prices) AS reference_at,
        (SELECT count(*) FROM current_prices) AS prix_actuels,
        (SELECT count(*) FROM current_prices WHERE est_prix_suspect) AS prix_suspects,
        (SELECT count(*) FROM current_prices WHERE nombre_jours_depuis_maj <= 7) AS prix_actuels_recents,
        (SELECT count(*) FROM price_changes) AS changements_de_prix,
        (SELECT count(*) FROM stations) AS stations"""

# Fuels, the header of the station export, and the constant tail of the metadata.
FUEL_ROWS = "(VALUES (1, 'Gazole'), (2, 'SP95'), (3, 'E85'), (4, 'GPLc'), (5, 'E10'), (6, 'SP98'))"
HEADER_TAIL = (
    '","colonnes_station":["id","latitude","longitude","adresse","ville","code_postal","autoroute",'
    '"prix"],"colonnes_prix":["fuel_id","prix","maj","age_jours","suspect"]}'
)


def metadata() -> str:
    rules = '"First rule of the caller.","A \\"second\\" one."'
    tail = (
        '},"source":{"producteur":"test tables","licence":"none"},"fuels":{"1":"Gazole","2":"SP95",'
        '"3":"E85","4":"GPLc","5":"E10","6":"SP98"},"regles_de_lecture":[' + rules + "],"
        '"derniere_execution":null}'
    )
    return f"""
    SELECT '{{"genere_le":"2024-02-15T12:00:00Z","reference_at":"' || v.reference_at
        || '","fichiers_source":[' || f.files || '],"volumes":{{"stations":' || v.stations
        || ',"prix_actuels":' || v.prix_actuels || ',"prix_actuels_recents":' || v.prix_actuels_recents
        || ',"prix_suspects":' || v.prix_suspects || ',"changements_de_prix":' || v.changements_de_prix
        || '{tail}' AS document
    FROM ({VOLUMES}) AS v
    CROSS JOIN (SELECT string_agg('{{"annee":' || _source_year || ',"fichier":"' || _source_file
        || '","sha256":"' || _source_sha256 || '","charge_le":"' || {stamp("_loaded_at")} || '"}}', ',')
        AS files FROM (SELECT DISTINCT _source_year, _source_file, _source_sha256, _loaded_at
                       FROM raw_stations)) AS f"""


BROKEN = {
    "raw_stations": where("raw_stations", "ville = 'BUILDING'", latitude="''"),
    "raw_prices": where("raw_prices", "prix_id = '5'", prix_id="'9'"),
}
SERIES_GAPS = """
    SELECT fuel_id, jour, suivant AS jour_suivant FROM (
        SELECT fuel_id, jour, lead(jour) OVER (PARTITION BY fuel_id ORDER BY jour) AS suivant
        FROM {source})
    WHERE suivant - jour <> 1"""
MISSING_FUELS = f"""
    SELECT CAST(id AS SMALLINT) AS fuel_id, nom AS fuel FROM {FUEL_ROWS} AS f(id, nom)
    WHERE id NOT IN (SELECT fuel_id FROM daily_medians)"""
UNKNOWN_FUELS = """
    SELECT fuel_id, count(*) AS lignes FROM current_prices
    WHERE fuel_id NOT BETWEEN 1 AND 6 GROUP BY fuel_id"""
EXPORT_CHECKS = f"""
    SELECT * FROM (
        SELECT 'error' AS niveau, 'no_station' AS regle,
            CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS cas FROM stations
        UNION ALL SELECT 'error', 'without_coordinates', count(*) FROM stations
            WHERE latitude IS NULL OR longitude IS NULL
        UNION ALL SELECT 'error', 'unknown_fuels', count(*) FROM ({UNKNOWN_FUELS})
        UNION ALL SELECT 'error', 'missing_fuels', count(*) FROM ({MISSING_FUELS})
        UNION ALL SELECT 'error', 'median_series_gaps', count(*)
            FROM ({SERIES_GAPS.format(source="daily_medians")})
        UNION ALL SELECT 'error', 'gap_series_gaps', count(*)
            FROM ({SERIES_GAPS.format(source=f"({GAP_DAYS}) WHERE fuel_id <> 2")})
        UNION ALL SELECT 'warn', 'stale',
            date_sub('day', max(maj_at), TIMESTAMP '2024-02-15 12:00:00') FROM staged_prices)
    WHERE cas > CASE WHEN regle = 'stale' THEN 2 ELSE 0 END"""

def figures(relation: str, total: str, others: dict[str, str]) -> str:
    """One query per figure over the rows of a year, put side by side; a year without such rows has 0."""
    names = "".join(f", CAST(coalesce({name}, 0) AS BIGINT) AS {name}" for name in others)
    sides = "".join(
        f" LEFT JOIN (SELECT _source_year, count(*) AS {name} FROM ({rows}) GROUP BY _source_year) USING (_source_year)"
        for name, rows in others.items()
    )
    whole = f"(SELECT _source_year, count(*) AS {total} FROM {relation} GROUP BY _source_year) AS y"
    return f"SELECT _source_year, {total}{names}{{more}} FROM {whole}{sides}"


DATED = "raw_prices WHERE maj IS NOT NULL"
PRICE_STATS = figures(
    "raw_prices",
    "releves",
    {
        "stations": f"SELECT DISTINCT _source_year, pdv_id FROM {DATED} AND pdv_id IS NOT NULL",
        "couples": f"SELECT DISTINCT _source_year, pdv_id, prix_id FROM {DATED}",
        "hors_annee": f"SELECT _source_year FROM {DATED} AND maj NOT LIKE CAST(_source_year AS VARCHAR) || '%'",
        "prix_vides": "SELECT _source_year FROM raw_prices WHERE prix_id IS NULL",
    },
).format(
    more=", (SELECT min(maj) FROM raw_prices AS r WHERE r._source_year = y._source_year) AS premier,"
    " (SELECT max(maj) FROM raw_prices AS r WHERE r._source_year = y._source_year) AS dernier"
)
STATION_STATS = figures(
    "raw_stations",
    "stations",
    {
        "identifiants": "SELECT DISTINCT _source_year, pdv_id FROM raw_stations WHERE pdv_id IS NOT NULL",
        "sans_adresse": "SELECT _source_year FROM raw_stations WHERE length(trim(coalesce(adresse, ''))) = 0",
        "sans_ville": "SELECT _source_year FROM raw_stations WHERE length(trim(coalesce(ville, ''))) = 0",
        "sans_coordonnees": "SELECT _source_year FROM raw_stations"
        " WHERE coalesce(latitude, '') = '' OR coalesce(longitude, '') = ''",
    },
).format(more="")
DAMAGED_STATIONS = f"""
    WITH blank AS (
        SELECT * REPLACE (
            CASE WHEN ville = 'BUILDING' THEN '  ' ELSE adresse END AS adresse,
            CASE WHEN ville = 'BUILDING' THEN '' ELSE latitude END AS latitude,
            CASE WHEN ville = 'MACHINERY' THEN NULL ELSE ville END AS ville)
        FROM ({CUSTOMER_STATIONS}))
    SELECT * FROM blank UNION ALL SELECT * FROM blank WHERE ville = 'HOUSEHOLD'"""

# --- checks ------------------------------------------------------------------------------------------

RAW_REPORT = "pdv_id prix_id maj _source_year"
ROWS_WITHOUT = """SELECT '{relation}' AS relation, '{column}' AS colonne, count(*) AS lignes
    FROM {relation} WHERE {column} IS NULL"""


# Columns that must not be NULL, by relation.
FILLED = {
    "raw_prices": "_source_year",
    "raw_stations": "pdv_id",
    "staged_prices": "station_id fuel_id fuel maj_at prix_litre",
    "staged_stations": "station_id _source_year",
    "prices_in_force": "station_id fuel_id jour prix_litre",
    "price_changes": "station_id fuel_id maj_at prix_litre est_premier_releve est_prix_suspect",
    "stations": "station_id adresse ville latitude longitude est_autoroute",
    "current_prices": "station_id fuel_id prix_litre maj_at est_prix_suspect nombre_jours_depuis_maj",
    "daily_medians": "jour fuel_id fuel prix_median nombre_stations",
    "motorway_gap": "jour departement fuel_id prix_median_autoroute prix_median_route "
    "nombre_stations_autoroute nombre_stations_route ecart",
}


def not_null() -> str:
    parts = [ROWS_WITHOUT.format(relation=r, column=c) for r, columns in FILLED.items() for c in columns.split()]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE lignes > 0"


def twice(relation: str, keys: str, name: str) -> str:
    listed = ", ".join(keys.split())
    return (
        pick(f"{keys} {name}", f"(SELECT {listed}, count(*) AS {name} FROM {relation} GROUP BY {listed})")
        + f" WHERE {name} > 1"
    )


def unexpected(relation: str, column: str, accepted: str) -> str:
    return f"""SELECT '{relation}' AS relation, '{column}' AS colonne, CAST({column} AS VARCHAR) AS valeur,
        count(*) AS lignes FROM {relation} WHERE {column} NOT IN ({accepted}) GROUP BY {column}"""


def childless(relation: str, parent: str) -> str:
    return f"""SELECT '{relation}' AS relation, CAST(station_id AS BIGINT) AS cle, count(*) AS lignes
        FROM {relation} WHERE station_id NOT IN (SELECT station_id FROM {parent}) GROUP BY station_id"""


SWAPPED = where("raw_stations", "ville = 'MACHINERY'", latitude="longitude", longitude="latitude")
ZEROED = where("raw_stations", "ville = 'FURNITURE'", latitude="'0'", longitude="'0'")
NAMES = "'Gazole', 'SP95', 'E85', 'GPLc', 'E10', 'SP98'"
TOO_LONG = f"""
    SELECT d.station_id, d.fuel_id, d.fuel, c.jour, d.prix_litre, d.jour AS releve_le,
        {suspect("d.fuel_id", "d.prix_litre")} AS est_prix_suspect
    FROM (SELECT *, lead(jour) OVER (PARTITION BY station_id, fuel_id ORDER BY jour) AS suivant
          FROM daily) AS d
    JOIN calendar AS c ON c.jour >= d.jour AND c.jour <= d.jour + 7
        AND (d.suivant IS NULL OR c.jour <= d.suivant)"""


def checks() -> dict[str, str]:
    spring = {**EVENT_LAKE, "raw_prices": event_prices(80)}

    def on_reports(query: str, fuel: str, price: str, **values: str) -> str:
        hit = f"prix_id = '{fuel}' AND valeur = '{price}'"
        return lake(query, raw_prices=where("raw_prices", hit, **values))

    conflicts = """SELECT count(*) - count(DISTINCT (pdv_id, prix_id, maj)) AS releves_en_conflit
        FROM raw_prices WHERE prix_id IS NOT NULL"""
    return {
        "maj_parsable": on_reports(
            pick(RAW_REPORT, "raw_prices")
            + " WHERE prix_id IS NOT NULL AND try_cast(maj AS TIMESTAMP) IS NULL",
            "5", "1.200", maj="'2024-02-30T08:61:00'",
        ),
        "maj_in_file_year": on_reports(
            pick(RAW_REPORT, "raw_prices") + " WHERE year(CAST(maj AS TIMESTAMP)) <> _source_year",
            "4", "1.300", maj="'1987-11-05T07:15:00'",
        ),
        "not_in_future": on_reports(
            pick("station_id fuel maj_at _loaded_at _source_file", "staged_prices")
            + " WHERE maj_at > _loaded_at",
            "4", "1.300", maj="'2051-07-14T09:30:00'",
        ),
        "empty_tags_alone": lake(
            """SELECT * FROM (SELECT pdv_id, _source_year, count(*) - count(prix_id) AS balises_vides,
                count(prix_id) AS vrais_prix FROM raw_prices GROUP BY pdv_id, _source_year)
               WHERE balises_vides > 1 OR (balises_vides = 1 AND vrais_prix > 0)""",
            raw_prices="""SELECT * FROM raw_prices_0 UNION ALL BY NAME
                SELECT COLUMNS(lambda c: c NOT IN ('prix_id', 'prix_nom', 'maj', 'valeur'))
                FROM raw_prices_0 WHERE prix_id = '5' AND pop = 'A'""",
        ),
        "spring_gap_hour": lake(
            pick(RAW_REPORT, "raw_prices") + " WHERE maj LIKE '2024-03-31T02:%'", spring
        ),
        "conflicts_rare": lake(f"SELECT * FROM ({conflicts}) WHERE releves_en_conflit > 10"),
        "staging_keeps_reports": lake(
            """SELECT * FROM (SELECT count(DISTINCT (pdv_id, prix_id, maj)) AS releves_source,
                count(DISTINCT (pdv_id, prix_id, maj)) FILTER (prix_id <> '5') AS releves_staging
               FROM raw_prices WHERE prix_id IS NOT NULL) WHERE releves_source <> releves_staging"""
        ),
        "unique_staging": lake(twice("reports", "station_id fuel_id maj_at", "prix")),
        "price_range": lake(
            pick("station_id fuel maj_at prix_litre", "staged_prices")
            + " WHERE prix_litre < 0.30 OR prix_litre > 4", ORDER_LAKE,
        ),
        "unique_station_year": lake(
            twice("staged_stations", "station_id _source_year", "lignes"),
            raw_stations="SELECT * FROM raw_stations_0 UNION ALL "
            "SELECT * FROM raw_stations_0 WHERE ville = 'BUILDING'",
        ),
        "stations_in_bounds": lake(
            pick("station_id _source_year code_postal latitude longitude", "staged_stations")
            + " WHERE (latitude BETWEEN 41 AND 51.5 AND longitude BETWEEN -5.5 AND 10) IS NOT TRUE"
            " AND (station_id, _source_year) IN (SELECT station_id, _source_year FROM staged_prices)",
            raw_stations=SWAPPED,
        ),
        "mart_stations_in_bounds": lake(
            pick("station_id code_postal latitude longitude", "stations")
            + " WHERE (latitude BETWEEN 41 AND 51.5 AND longitude BETWEEN -5.5 AND 10) IS FALSE",
            raw_stations=ZEROED,
        ),
        "changes_differ": lake(
            "SELECT station_id, fuel_id, CAST(maj_at AS VARCHAR) AS maj_at, "
            "CAST(prix_litre AS DOUBLE) AS prix_precedent, CAST(prix_litre AS DOUBLE) AS prix_litre "
            "FROM price_changes WHERE NOT est_premier_releve"
        ),
        "one_first_report": lake(
            """SELECT station_id, fuel_id, CAST(0 AS BIGINT) AS premiers_releves FROM staged_prices
               GROUP BY station_id, fuel_id
               QUALIFY row_number() OVER (PARTITION BY station_id
                   ORDER BY min(maj_at), fuel_id) > 1"""
        ),
        "unique_current": lake(
            """SELECT station_id, fuel_id, least(count(*), 2) AS prix FROM staged_prices
               GROUP BY station_id, fuel_id HAVING count(*) > 1"""
        ),
        "current_equals_last_change": lake(
            """SELECT station_id, fuel_id, CAST(arg_min(prix_litre, maj_at) AS DOUBLE) AS prix_actuel,
                CAST(arg_max(prix_litre, maj_at) AS DOUBLE) AS prix_dernier_changement
               FROM staged_prices GROUP BY station_id, fuel_id
               HAVING arg_min(prix_litre, maj_at) <> arg_max(prix_litre, maj_at)"""
        ),
        "age_not_negative": lake(
            f"""SELECT * FROM (SELECT c.station_id, c.fuel_id, CAST(c.maj_at AS VARCHAR) AS maj_at,
                CAST(d.debut AS VARCHAR) AS reference_at,
                CAST({paris("d.debut")} AS DATE) - CAST({paris("c.maj_at")} AS DATE)
                    AS nombre_jours_depuis_maj
               FROM current_prices AS c CROSS JOIN (SELECT min(maj_at) AS debut FROM staged_prices) AS d)
               WHERE nombre_jours_depuis_maj < 0"""
        ),
        "medians_station_bound": lake(
            """SELECT CAST(m.jour AS VARCHAR) AS jour, m.fuel, m.nombre_stations, p.n AS stations_possibles
               FROM daily_medians AS m JOIN (
                   SELECT c.jour, d.fuel_id, count(DISTINCT d.station_id) AS n
                   FROM calendar AS c JOIN daily AS d ON d.jour >= c.jour - 7 AND d.jour <= c.jour
                   GROUP BY c.jour, d.fuel_id) AS p
                 ON p.jour = m.jour AND p.fuel_id = m.fuel_id
               WHERE m.nombre_stations > p.n""",
            prices_in_force=TOO_LONG,
        ),
        "no_mojibake": """SELECT CAST(c_custkey + 1 AS INTEGER) AS station_id, CAST(2024 AS SMALLINT)
                AS _source_year, 'Ã' || chr(137) || ' ' || c_name AS adresse, c_mktsegment AS ville
               FROM customer WHERE c_mktsegment = 'BUILDING'""",
        "suspect_share": lake(
            """SELECT * FROM (SELECT count(*) FILTER (est_prix_suspect) AS prix_suspects,
                count(*) AS prix_actuels FROM current_prices)
               WHERE prix_suspects > 0.01 * prix_actuels""",
            raw_prices=where("raw_prices", "prix_id = '3'", valeur="'1.990'"),
        ),
        "not_null": lake(
            not_null(),
            raw_stations=where("raw_stations", "ville = 'BUILDING'", adresse="NULL", latitude="''"),
            raw_prices="""SELECT * REPLACE (CASE WHEN prix_id <> '1' THEN prix_nom END AS prix_nom,
                CASE WHEN prix_id = '2' AND valeur = '1.400' THEN NULL ELSE valeur END AS valeur)
                FROM raw_prices_0""",
        ),
        "accepted_values": lake(
            " UNION ALL ".join([
                unexpected("raw_prices", "prix_id", "'1', '2', '3', '4', '5', '6'"),
                unexpected("raw_stations", "pop", "'R', 'A', 'N'"),
                unexpected("staged_prices", "fuel_id", "1, 2, 3, 4, 5, 6"),
                unexpected("staged_prices", "fuel", NAMES),
            ]),
            raw_stations=where("raw_stations", "ville = 'BUILDING'", pop="'X'"),
        ),
        "relationships": lake(
            " UNION ALL ".join([
                childless("staged_prices", "staged_stations"),
                childless("price_changes", "stations"),
                childless("current_prices", "stations"),
            ]),
            raw_stations="SELECT * FROM raw_stations_0 WHERE ville <> 'BUILDING'",
        ),
        "unique_station": lake(
            "SELECT station_id, CAST(2 AS BIGINT) AS lignes FROM stations WHERE ville = 'BUILDING'"
        ),
    }


EVENT_REPORTS = f"""
    SELECT CAST(user_id + 1 AS VARCHAR) AS pdv_id, {_place("user_id", "user_id")},
        {FUEL} AS prix_id, event_type AS prix_nom, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS maj,
        {PRICE} AS valeur, {_lineage("2024", "events")}
    FROM events"""
CLEAN_LAKE = {
    "raw_prices": f"""SELECT * FROM ({EVENT_REPORTS}) UNION ALL
        SELECT * REPLACE ('1.000' AS valeur) FROM (
            SELECT * FROM ({EVENT_REPORTS}) ORDER BY pdv_id, prix_id, maj LIMIT 2)""",
    "raw_stations": CUSTOMER_STATIONS,
}


# The pair whose rows are damaged.
STATION = f"(SELECT min(CAST(pdv_id AS INTEGER)) FROM ({EVENT_REPORTS}))"
PRODUCT = f"(SELECT min(CAST(prix_id AS INTEGER)) FROM ({EVENT_REPORTS}) WHERE CAST(pdv_id AS INTEGER) = {STATION})"
RAW_HIT = f"CAST(pdv_id AS INTEGER) = {STATION} AND CAST(prix_id AS INTEGER) = {PRODUCT}"
HIT = f"station_id = {STATION} AND fuel_id = {PRODUCT}"
PLACE_HIT = f"station_id = {STATION}"


def proofs() -> str:
    """What each check counts on the clean relations and on one damaged relation."""

    def more(relation: str, condition: str, copies: int = 1) -> str:
        return f"""SELECT * FROM {relation}_0 UNION ALL
            SELECT r.* FROM {relation}_0 AS r, range({copies}) WHERE {condition}"""

    def double(relation: str, keys: str) -> str:
        return f"SELECT {keys} FROM {relation} GROUP BY ALL HAVING count(*) > 1"

    distinct = "SELECT DISTINCT pdv_id, prix_id, maj FROM raw_prices WHERE prix_id IS NOT NULL"
    last_change = "SELECT station_id, fuel_id, arg_max(prix_litre, maj_at) AS p FROM price_changes GROUP BY ALL"
    tags = f"""SELECT * FROM raw_prices_0 UNION ALL
        SELECT * REPLACE (NULL AS prix_id, NULL AS prix_nom, NULL AS maj, NULL AS valeur) FROM raw_prices_0 WHERE {RAW_HIT}"""
    found: dict[str, tuple[str, str, str]] = {
        "maj_parsable": (
            "raw_prices", where("raw_prices", RAW_HIT, maj="reverse(maj)"),
            "SELECT 1 FROM raw_prices WHERE prix_id IS NOT NULL AND try_cast(maj AS TIMESTAMP) IS NULL",
        ),
        "maj_in_file_year": (
            "raw_prices", where("raw_prices", RAW_HIT, _source_year="_source_year + 1"),
            "SELECT 1 FROM raw_prices WHERE year(CAST(maj AS TIMESTAMP)) <> _source_year",
        ),
        "not_in_future": (
            "staged_prices", where("staged_prices", HIT, _loaded_at="maj_at - INTERVAL 1 DAY"),
            "SELECT 1 FROM staged_prices WHERE maj_at > _loaded_at",
        ),
        "empty_tags_alone": (
            "raw_prices", tags,
            """SELECT 1 FROM raw_prices GROUP BY pdv_id, _source_year
               HAVING count(*) > count(prix_id) AND (count(*) - count(prix_id) > 1 OR count(prix_id) > 0)""",
        ),
        "spring_gap_hour": (
            "raw_prices", where("raw_prices", RAW_HIT, maj="'2024-03-31T02' || substr(maj, 14, 6)"),
            "SELECT 1 FROM raw_prices WHERE maj LIKE '2024-03-31T02:%'",
        ),
        "conflicts_rare": (
            "raw_prices", more("raw_prices", RAW_HIT, 11),
            f"SELECT 1 FROM raw_prices WHERE prix_id IS NOT NULL HAVING count(*) - (SELECT count(*) FROM ({distinct})) > 10",
        ),
        "staging_keeps_reports": (
            "staged_prices", f"SELECT * FROM staged_prices_0 WHERE NOT ({HIT})",
            f"SELECT 1 FROM staged_prices HAVING count(*) <> (SELECT count(*) FROM ({distinct}))",
        ),
        "unique_staging": ("staged_prices", more("staged_prices", HIT), double("staged_prices", "station_id, fuel_id, maj_at")),
        "price_range": (
            "staged_prices", where("staged_prices", HIT, prix_litre="4.001"),
            "SELECT 1 FROM staged_prices WHERE prix_litre NOT BETWEEN 0.30 AND 4",
        ),
        "unique_station_year": (
            "staged_stations", more("staged_stations", PLACE_HIT), double("staged_stations", "station_id, _source_year")
        ),
        "stations_in_bounds": (
            "staged_stations", where("staged_stations", PLACE_HIT, latitude="52.5"),
            """SELECT 1 FROM staged_stations SEMI JOIN staged_prices USING (station_id, _source_year)
               WHERE (latitude BETWEEN 41 AND 51.5 AND longitude BETWEEN -5.5 AND 10) IS NOT TRUE""",
        ),
        "mart_stations_in_bounds": (
            "stations", where("stations", PLACE_HIT, longitude="-6.5"),
            "SELECT 1 FROM stations WHERE latitude NOT BETWEEN 41 AND 51.5 OR longitude NOT BETWEEN -5.5 AND 10",
        ),
        "changes_differ": (
            "price_changes", where("price_changes", HIT, prix_precedent="prix_litre", est_premier_releve="FALSE"),
            "SELECT 1 FROM price_changes WHERE NOT est_premier_releve AND (prix_precedent IS NULL OR prix_precedent = prix_litre)",
        ),
        "one_first_report": (
            "price_changes", where("price_changes", HIT, est_premier_releve="FALSE"),
            """SELECT 1 FROM (SELECT DISTINCT station_id, fuel_id, 0 AS n FROM staged_prices
                   UNION ALL SELECT station_id, fuel_id, 1 FROM price_changes WHERE est_premier_releve)
               GROUP BY station_id, fuel_id HAVING sum(n) <> 1""",
        ),
        "unique_current": ("current_prices", more("current_prices", HIT), double("current_prices", "station_id, fuel_id")),
        "current_equals_last_change": (
            "current_prices", where("current_prices", HIT, prix_litre="prix_litre + 0.001"),
            f"SELECT 1 FROM current_prices LEFT JOIN ({last_change}) USING (station_id, fuel_id) WHERE p IS NULL OR p <> prix_litre",
        ),
        "age_not_negative": (
            "current_prices", where("current_prices", HIT, nombre_jours_depuis_maj="-1 - nombre_jours_depuis_maj"),
            "SELECT 1 FROM current_prices WHERE nombre_jours_depuis_maj < 0",
        ),
        "medians_station_bound": (
            "daily_medians", where("daily_medians", f"fuel_id = {PRODUCT}", nombre_stations="nombre_stations + 1099511627776"),
            """SELECT 1 FROM daily_medians AS m JOIN (
                   SELECT c.jour, d.fuel_id, count(DISTINCT d.station_id) AS n
                   FROM calendar AS c JOIN daily AS d ON d.jour >= c.jour - 7 AND d.jour <= c.jour
                   GROUP BY c.jour, d.fuel_id) AS p
                 ON p.jour = m.jour AND p.fuel_id = m.fuel_id
               WHERE m.nombre_stations > p.n""",
        ),
        "no_mojibake": (
            "staged_stations", where("staged_stations", PLACE_HIT, adresse="'Ã' || chr(169) || adresse"),
            "SELECT 1 FROM staged_stations WHERE regexp_matches(coalesce(adresse, '') || ' ' || coalesce(ville, ''), 'Ã[\\x{80}-\\x{BF}]')",
        ),
        "suspect_share": (
            "current_prices", where("current_prices", f"fuel_id = {PRODUCT}", est_prix_suspect="TRUE"),
            "SELECT 1 FROM current_prices HAVING count(*) FILTER (est_prix_suspect) > 0.01 * count(*)",
        ),
        "not_null": ("staged_prices", where("staged_prices", HIT, fuel="NULL"), not_null()),
        "accepted_values": (
            "staged_prices", where("staged_prices", HIT, fuel_id="7"),
            " UNION ALL ".join([
                unexpected("raw_prices", "prix_id", "'1', '2', '3', '4', '5', '6'"),
                unexpected("raw_stations", "pop", "'R', 'A', 'N'"),
                unexpected("staged_prices", "fuel_id", "1, 2, 3, 4, 5, 6"),
                unexpected("staged_prices", "fuel", NAMES),
            ]),
        ),
        "relationships": (
            "current_prices", where("current_prices", PLACE_HIT, station_id="-station_id"),
            " UNION ALL ".join([
                childless("staged_prices", "staged_stations"),
                childless("price_changes", "stations"),
                childless("current_prices", "stations"),
            ]),
        ),
        "unique_station": ("stations", more("stations", PLACE_HIT), double("stations", "station_id")),
    }
    # A damaged relation is a stored one: what derives from it keeps its old rows.
    parts = []

    def part(name: str, defect: str, relation: str, broken: str) -> None:
        counted = lake(f"SELECT count(*) AS n FROM ({found[name][2]})", CLEAN_LAKE)
        parts.append(
            f"""SELECT '{name}' AS controle, '{defect}' AS defaut, '{relation}' AS relation, a.n AS temoin, b.n AS violations,
                CASE WHEN b.n = 0 THEN 'pass' ELSE '{"warn" if name == "suspect_share" else "fail"}' END AS statut, b.n > a.n AS detecte
            FROM ({counted}) AS a, ({broken}) AS b"""
        )

    for name, (relation, damaged, query) in found.items():
        on_damaged = re.sub(rf"\b{relation}\b", "damaged", f"SELECT count(*) AS n FROM ({query})")
        part(name, "beyond the limit", relation, lake(on_damaged, CLEAN_LAKE, damaged=damaged.replace(f"{relation}_0", relation)))

    # A defect goes through everything that derives from the changed relation.
    for name, defect, relation, changed, *other in scenarios():
        query = other[0] if other else found[name][2]
        part(name, defect, relation, lake(f"SELECT count(*) AS n FROM ({query})", CLEAN_LAKE, **changed))
    return " UNION ALL ".join(parts)


def scenarios() -> list[tuple]:
    """Check, defect, relation, changed relations, and the check's statement where it needs another one."""
    whole = "pdv_id IS NOT NULL AND prix_id IS NOT NULL AND maj IS NOT NULL"
    first = f"""concat_ws('|', pdv_id, prix_id, maj) = (SELECT concat_ws('|', pdv_id, prix_id, maj)
        FROM raw_prices_0 WHERE {whole} ORDER BY pdv_id, prix_id, maj LIMIT 1)"""
    newest = f"""pdv_id = (SELECT min(pdv_id) FROM raw_prices WHERE {whole})
        AND _source_year = (SELECT max(_source_year) FROM raw_prices WHERE {whole})"""
    in_order = f"FROM raw_prices_0 WHERE {whole} ORDER BY pdv_id, prix_id, maj, valeur LIMIT"

    def on_first(**values: str) -> dict[str, str]:
        return {"raw_prices": where("raw_prices", first, **values)}

    def on_newest(**values: str) -> dict[str, str]:
        return {"raw_stations": where("raw_stations", newest, **values)}

    def added(relation: str, rows: str) -> dict[str, str]:
        return {relation: f"SELECT * FROM {relation}_0 UNION ALL (SELECT {rows})"}

    def ranked(order: str, limit: int) -> dict[str, str]:
        return {"current_prices": f"""SELECT * FROM staged_prices
            QUALIFY row_number() OVER (PARTITION BY station_id, fuel_id ORDER BY {order}) <= {limit}"""}

    return [
        ("maj_parsable", "unreadable time", "raw_prices", on_first(maj="'2025-13-45T25:00:00'")),
        ("maj_in_file_year", "report of another year", "raw_prices", on_first(maj="'1990-06-01T10:00:00'")),
        (
            "empty_tags_alone", "empty tag beside prices", "raw_prices",
            added("raw_prices", f"* REPLACE (NULL AS prix_id, NULL AS prix_nom, NULL AS maj, NULL AS valeur) {in_order} 1"),
        ),
        (
            "spring_gap_hour", "report in the missing hour", "raw_prices", on_first(maj="'2025-03-30T02:30:00'"),
            "SELECT 1 FROM raw_prices WHERE maj LIKE '2024-03-31T02:%' OR maj LIKE '2025-03-30T02:%'",
        ),
        (
            "conflicts_rare", "too many conflicts", "raw_prices",
            added("raw_prices", f"* REPLACE (CAST(CAST(valeur AS DECIMAL(8,3)) + 0.100 AS VARCHAR) AS valeur) {in_order} 11"),
        ),
        (
            "staging_keeps_reports", "fuel lost in staging", "staged_prices",
            {"staged_prices": "SELECT * FROM staged_prices_0 WHERE fuel_id <> (SELECT CAST(max(prix_id) AS SMALLINT) FROM raw_prices)"},
        ),
        ("unique_staging", "conflicts not resolved", "staged_prices", {"staged_prices": "SELECT * FROM reports"}),
        ("price_range", "price in thousandths", "raw_prices", on_first(valeur="'1638'")),
        (
            "unique_station_year", "station listed twice", "raw_stations",
            added("raw_stations", "* FROM raw_stations_0 ORDER BY pdv_id, _source_year LIMIT 1"),
        ),
        ("stations_in_bounds", "coordinates swapped", "raw_stations", on_newest(latitude="longitude", longitude="latitude")),
        ("mart_stations_in_bounds", "coordinates at zero", "raw_stations", on_newest(latitude="'0'", longitude="'0'")),
        (
            "changes_differ", "repeats kept", "price_changes",
            added("price_changes", "* REPLACE (prix_litre AS prix_precedent) FROM price_changes_0 WHERE NOT est_premier_releve"),
        ),
        (
            "one_first_report", "history by station only", "price_changes",
            {"price_changes": """SELECT * REPLACE (est_premier_releve AND row_number() OVER (PARTITION BY station_id
                ORDER BY maj_at, fuel_id) = 1 AS est_premier_releve) FROM price_changes_0"""},
        ),
        ("unique_current", "two last prices kept", "current_prices", ranked("maj_at DESC, prix_litre DESC", 2)),
        ("current_equals_last_change", "first price taken", "current_prices", ranked("maj_at, prix_litre", 1)),
        (
            "age_not_negative", "reference at the first report", "current_prices",
            {"current_prices": f"""SELECT c.* REPLACE (CAST({paris("d.debut")} AS DATE) - CAST({paris("c.maj_at")} AS DATE)
                AS nombre_jours_depuis_maj) FROM current_prices_0 AS c CROSS JOIN (SELECT min(maj_at) AS debut FROM staged_prices) AS d"""},
        ),
        ("not_in_future", "report after its load", "raw_prices", on_first(maj="'2099-12-31T12:00:00'")),
        ("no_mojibake", "repair removed", "staged_stations", on_newest(adresse="'Ã' || chr(137) || ' ' || adresse")),
        ("medians_station_bound", "period one day too long", "validity_periods", {"prices_in_force": TOO_LONG}),
        ("suspect_share", "E85 at petrol price", "raw_prices", {"raw_prices": where("raw_prices", "prix_id = '3'", valeur="'1.990'")}),
    ]


def oracle() -> dict[str, str]:
    years = {**EVENT_LAKE, "raw_prices": event_prices(340)}
    shifted = {days: {**EVENT_LAKE, "raw_prices": event_prices(days)} for days in (80, 280)}
    local = " UNION ALL ".join(
        f"SELECT event_id, CAST({hour_text(d)} AS TIMESTAMP) AS local FROM events" for d in (80, 280)
    )
    value = (
        "CAST(CAST(floor(l_discount * 1000) - floor(l_tax * 1000) * 2 + l_linenumber AS BIGINT) "
        "* CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(8,3))"
    )
    tables = {"stations": STATIONS, "price_changes": CHANGES, "current_prices": CURRENT, "daily_medians": MEDIANS, "motorway_gap": GAP}
    kept_after = "(_source_year <> 1998 OR prix_id = '1')"
    return {
        "stg_prices": lake(pick(STAGED, "staged_prices")),
        "stg_prices_spring": lake(pick(STAGED, "staged_prices"), shifted[80]),
        "stg_prices_autumn": lake(pick(STAGED, "staged_prices"), shifted[280]),
        "stg_prices_years": lake(pick(STAGED, "staged_prices"), ORDER_LAKE),
        "stg_stations": lake(
            pick(
                "station_id adresse ville code_postal latitude longitude est_autoroute _source_year "
                "_source_file _loaded_at",
                "staged_stations",
            )
        ),
        "price_changes": lake(pick(CHANGES, "price_changes")),
        "price_changes_months": lake(pick(CHANGES, "price_changes"), {**EVENT_LAKE, "raw_prices": event_prices(15)}),
        "price_changes_years": lake(pick(CHANGES, "price_changes"), ORDER_LAKE),
        "current_prices": lake(pick(CURRENT, "current_prices")),
        "current_prices_years": lake(pick(CURRENT, "current_prices"), ORDER_LAKE),
        "station_dim": lake(pick(STATIONS, "stations")),
        "station_dim_years": lake(pick(STATIONS, "stations"), ORDER_LAKE),
        "prices_in_force": lake(pick(IN_FORCE, "prices_in_force")),
        "prices_in_force_autumn": lake(pick(IN_FORCE, "prices_in_force"), shifted[280]),
        "prices_in_force_years": lake(pick(IN_FORCE, "prices_in_force"), ORDER_LAKE),
        "daily_medians": lake(pick(MEDIANS, "daily_medians")),
        "daily_medians_years": lake(pick(MEDIANS, "daily_medians"), ORDER_LAKE),
        "motorway_gap": lake(pick(GAP, "motorway_gap")),
        "motorway_gap_years": lake(pick(GAP, "motorway_gap"), ORDER_LAKE),
        "gap_summary": lake(GAP_SUMMARY),
        "gap_by_year": lake(GAP_YEARS),
        "gap_by_day": lake(pick("fuel_id jour ecart_median departements", f"({GAP_DAYS})")),
        "xml_stations": f"""SELECT {ARCHIVE} AS source_file, {ATTRIBUTES},
            'Allée Été & ' || c_name || ' ' AS adresse, c_mktsegment AS ville
            FROM ({LISTED}) JOIN customer USING (c_custkey)""",
        "xml_prices": f"""SELECT {ARCHIVE} AS source_file, {ATTRIBUTES}, prix_id, prix_nom, maj, valeur
            FROM ({TAGS}) JOIN customer USING (c_custkey)""",
        "xml_empty_tags": f"""SELECT {ARCHIVE} AS source_file, count(*) - count(prix_id) AS prix_vides
            FROM ({TAGS}) GROUP BY lot""",
        "archive_unpack": f"""SELECT {ARCHIVE} AS source_file, count(*) AS elements, count(*) - 1 AS dernier
            FROM ({LISTED}) GROUP BY lot""",
        "source_hash": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
        "raw_lineage": f"""SELECT CAST(2024 AS SMALLINT) AS _source_year, {ARCHIVE} AS _source_file,
            '2024-12-31 06:00:00' AS _loaded_at, count(*) AS lignes,
            TRUE AS empreinte_exacte FROM ({TAGS}) GROUP BY lot""",
        "raw_union": f"""SELECT pdv_id, cp, CASE WHEN _source_year > 1996 THEN pop END AS pop, ville,
            _source_year FROM ({YEARLY_STATIONS})""",
        "raw_counts": f"""SELECT 'prix' AS entite, _source_year, count(*) AS lignes
            FROM ({ORDER_PRICES}) GROUP BY _source_year UNION ALL
            SELECT 'stations', _source_year, count(*) FROM ({YEARLY_STATIONS}) GROUP BY _source_year""",
        "raw_write": pick(
            "pdv_id latitude longitude cp pop prix_id prix_nom maj valeur _source_year _source_file _source_sha256 "
            "_loaded_at",
            f"({ORDER_PRICES}) WHERE {kept_after}",
        ),
        "raw_price_stats": lake(PRICE_STATS),
        "raw_price_stats_years": lake(PRICE_STATS, ORDER_LAKE),
        "raw_price_findings": lake(
            f"""SELECT _source_year, niveau, regle, valeur FROM ({PRICE_STATS}) AS s CROSS JOIN LATERAL (
                SELECT 'error' AS niveau, 'no_dated_report' AS regle, s.releves AS valeur
                    WHERE s.dernier IS NULL
                UNION ALL SELECT 'warn', 'empty_price_tags', s.prix_vides WHERE s.prix_vides > 0
                UNION ALL SELECT 'warn', 'outside_year', s.hors_annee WHERE s.hors_annee > 0
                UNION ALL SELECT 'warn', 'stale', DATE '2024-12-31' - CAST(left(s.dernier, 10) AS DATE)
                    WHERE DATE '2024-12-31' - CAST(left(s.dernier, 10) AS DATE) > 2)
                WHERE _source_year = 2024
                UNION ALL VALUES (2022, 'error', 'no_dated_report', 0), (2021, 'error', 'no_archive', 0)""",
            years,
        ),
        "raw_station_stats": lake(STATION_STATS, {"raw_stations": DAMAGED_STATIONS}),
        "raw_station_findings": lake(
            f"""SELECT _source_year, 'warn' AS niveau, regle, valeur FROM ({STATION_STATS}) AS s
                CROSS JOIN LATERAL (SELECT 'duplicated_ids' AS regle, s.stations - s.identifiants AS valeur
                UNION ALL SELECT 'sans_adresse', s.sans_adresse
                UNION ALL SELECT 'sans_ville', s.sans_ville
                UNION ALL SELECT 'sans_coordonnees', s.sans_coordonnees) WHERE valeur > 0
                UNION ALL VALUES (2023, 'error', 'no_station', 0)""",
            {"raw_stations": DAMAGED_STATIONS},
        ),
        "missing_years": """SELECT CAST(y AS INTEGER) AS annee, 'missing' AS raison FROM range(1992, 2000) AS t(y)
            WHERE y NOT IN (SELECT year(o_orderdate) FROM orders INTERSECT SELECT year(l_shipdate) FROM lineitem)
            UNION ALL VALUES (2000, 'previous_year'), (2001, 'current_year')""",
        "run_results": """SELECT CASE WHEN event_type = 'signup' THEN 'model' ELSE 'test' END AS type_noeud,
            CASE WHEN value > 450 THEN 'fail' WHEN event_type = 'signup' THEN 'success' ELSE 'pass' END AS statut,
            count(*) AS noeuds FROM events GROUP BY ALL""",
        "run_summary": """SELECT 'build' AS commande, 'tout le projet' AS selection, '2024-12-31T06:00:00Z' AS genere_le,
            round(event_id // 500 + 0.26, 1)::DOUBLE AS duree_s FROM events GROUP BY event_id // 500""",
        "mart_write": lake(" UNION ALL ".join(row_digests(name, columns) for name, columns in tables.items())),
        "suspect_flag": lake(
            f"""SELECT fuel_id, CAST(prix_litre AS DOUBLE) AS prix_litre, {suspect()} AS est_prix_suspect,
            count(*) AS releves FROM reports GROUP BY fuel_id, reports.prix_litre"""
        ),
        # No text of the table is damaged, so each stays as it is, and a damaged copy gives it back.
        "text_repair": """SELECT doc_id, md5(text) AS repare_md5,
            regexp_matches(text, '[À-ÿ]') OR NOT regexp_matches(text, '[^\\x00-\\x7F]') AS dommage_repare
            FROM documents""",
        "paris_instants": f"""SELECT event_id, CAST(local AS VARCHAR) AS local,
            CAST({utc("local")} AS VARCHAR) AS utc,
            CAST(CAST({paris(utc("local"))} AS DATE) AS VARCHAR) AS jour FROM ({local})""",
        "decimal_quantiles": pick(
            "l_suppkey q1 mediane q3",
            f"""(SELECT l_suppkey, quantile_cont(v, 0.25) AS q1, median(v) AS mediane,
                quantile_cont(v, 0.75) AS q3 FROM (SELECT l_suppkey, {value} AS v FROM lineitem)
                GROUP BY l_suppkey)""",
        ),
        "snapshot_retention": pick("annee jour sha256 octets", f"({KEPT})"),
        "snapshot_dropped": pick(
            "annee jour sha256 octets",
            f"({MANIFEST}) WHERE (annee, jour, sha256) NOT IN (SELECT annee, jour, sha256 FROM ({KEPT}))",
        ),
        "snapshot_freed": f"""SELECT annee, count(*) FILTER (garde) AS gardes,
            count(*) FILTER (NOT garde) AS supprimes,
            CAST(coalesce(sum(octets) FILTER (NOT garde), 0) AS BIGINT) AS octets_liberes
            FROM (SELECT annee, octets, (annee, jour) IN (SELECT annee, jour FROM ({KEPT})) AS garde
                  FROM ({MANIFEST})) GROUP BY annee""",
        "publish_decision": f"""SELECT annee, CAST(jour AS VARCHAR) AS jour, sha256,
            raison IN ('past_year', 'end_of_week') AS publier, raison
            FROM (SELECT *, CASE WHEN EXISTS (
                    SELECT 1 FROM orders AS o WHERE o.o_orderkey // 200 = m.annee
                        AND o.o_orderstatus = 'F' AND o.o_orderpriority = '5-LOW'
                        AND sha256(o.o_orderstatus || o.o_orderpriority) = m.sha256)
                    THEN 'already_published'
                WHEN annee < 5 THEN 'past_year' ELSE 'not_sunday' END AS raison
                FROM ({MANIFEST}) AS m WHERE (annee, sha256, jour) IN (
                    SELECT annee, sha256, max(jour) FROM ({MANIFEST}) GROUP BY annee, sha256))""",
        "station_sample": SAMPLE.format(
            prices=ORDER_PRICES, source="prices",
            columns="pdv_id, prix_id, prix_nom, maj, valeur, _source_year",
        ),
        "station_sample_versions": SAMPLE.format(
            prices=ORDER_PRICES, source=f"({YEARLY_STATIONS})",
            columns="pdv_id, adresse, ville, _source_year",
        ),
        "export_stations": lake(STATION_LINES),
        "export_header": lake(
            f"""SELECT '{{"reference_at":"' || {stamp("max(maj_at)")} || '{HEADER_TAIL}' AS document
            FROM staged_prices"""
        ),
        "export_medians": lake(MEDIAN_SERIES),
        "export_gap": lake(GAP_SERIES),
        "export_metadata": lake(VOLUMES),
        "export_files": lake(
            f"""SELECT DISTINCT _source_year AS annee, _source_file AS fichier, _source_sha256 AS sha256,
            {stamp("_loaded_at")} AS charge_le FROM raw_stations""",
            ORDER_LAKE,
        ),
        "export_document": lake(metadata()),
        "export_checks": lake(EXPORT_CHECKS, **BROKEN),
        "series_gaps": lake(
            pick(
                "fuel_id jour jour_suivant",
                f"({SERIES_GAPS.format(source='(SELECT DISTINCT fuel_id, jour_releve AS jour FROM reports)')})",
            ),
            ORDER_LAKE,
        ),
        "missing_fuels": lake(MISSING_FUELS),
        "unknown_fuels": lake(UNKNOWN_FUELS, **BROKEN),
        "defect_injection": proofs(),
        **{f"dq_{name}": sql for name, sql in checks().items()},
    }
