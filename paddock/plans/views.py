"""Dashboard views over Gold: the wide master view, its column subsets,
the DISTINCT season view and the incidents union.

A driver or team that is shuffled meets the fact while it is narrow, one that is
broadcast meets it last, and the circuit meets the race; all the rest joins by
race (see ``gold``). Subset views are plain projections of the master DataFrame, so Catalyst
prunes unused columns down to the scans. The two standings joins are
left outer on (race, driver) and (race, team); their right sides are not
unique per key in general, so a left join may add rows, exactly like the
SQL view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import join_dimension, spread
from .gold import GoldModels

# Display names of the master view, in order, with the
# Gold column each one shows.
MASTER_COLUMNS = (
    ("r.race_key", "Race Key"),
    ("r.year", "Season"),
    ("r.race_name", "Race Name"),
    ("r.round", "Round"),
    ("r.race_date", "Race Date"),
    ("c.circuit_name", "Circuit"),
    ("c.city", "City"),
    ("c.country", "Country"),
    ("c.latitude", "Latitude"),
    ("c.longitude", "Longitude"),
    ("c.altitude_meters", "Altitude (m)"),
    ("fr.driver_full_name", "Driver"),
    ("fr.driver_id", "Driver ID"),
    ("d.driver_code", "Driver Code"),
    ("d.nationality", "Driver Nationality"),
    ("d.date_of_birth", "Date of Birth"),
    ("fr.team_name", "Team"),
    ("fr.team_id", "Team ID"),
    ("t.nationality", "Team Nationality"),
    ("fr.car_number", "Car Number"),
    ("fr.grid_position", "Grid Position"),
    ("fr.finish_position", "Finish Position"),
    ("fr.position_order", "Position Order"),
    ("fr.points", "Points"),
    ("fr.laps", "Laps Completed"),
    ("fr.race_time_ms", "Race Time (ms)"),
    ("fr.fastest_lap_number", "Fastest Lap Number"),
    ("fr.fastest_lap_rank", "Fastest Lap Rank"),
    ("fr.fastest_lap_speed", "Fastest Lap Speed"),
    ("fr.status", "Finish Status"),
    ("fr.dnf_flag", "DNF"),
    ("fr.positions_gained", "Positions Gained"),
    ("fr.pit_stop_count", "Pit Stops"),
    ("fr.total_pit_time_ms", "Total Pit Time (ms)"),
    ("sd.points", "Driver Championship Points"),
    ("sd.position", "Driver Championship Position"),
    ("sd.wins", "Driver Championship Wins"),
    ("st.points", "Team Championship Points"),
    ("st.position", "Team Championship Position"),
    ("st.wins", "Team Championship Wins"),
)

# The overview subset of the master view.
OVERVIEW_COLUMNS = (
    "Race Key", "Season", "Race Name", "Round", "Race Date", "Circuit", "City", "Country",
    "Latitude", "Longitude", "Altitude (m)", "Driver", "Team", "Grid Position",
    "Finish Position", "Points", "Finish Status", "DNF", "Pit Stops",
)

# The drivers-and-teams subset of the master view.
DRIVERS_TEAMS_COLUMNS = (
    "Race Key", "Season", "Race Name", "Race Date", "Driver", "Driver ID", "Driver Code",
    "Driver Nationality", "Date of Birth", "Team", "Team ID", "Team Nationality", "Car Number",
    "Grid Position", "Finish Position", "Points", "Laps Completed", "Fastest Lap Rank",
    "Fastest Lap Speed", "Finish Status", "DNF", "Positions Gained", "Pit Stops",
    "Total Pit Time (ms)",
)

# The DISTINCT season subset (the race key stays in, so the
# grain is race x driver x team).
SEASON_COLUMNS = (
    "Season", "Driver", "Driver ID", "Driver Nationality", "Team", "Team ID",
    "Driver Championship Points", "Driver Championship Position", "Driver Championship Wins",
    "Team Championship Points", "Team Championship Position", "Team Championship Wins",
    "Race Key",
)


def historical_master(gold: GoldModels) -> DataFrame:
    fr, left = gold.results_with_dimensions()
    fr = fr.alias("fr")
    c = gold.ref("dim_circuits")
    r = join_dimension(gold.ref("dim_races"), c.select(*(F.col(n).alias(f"c_{n}") for n in c.columns)), "circuit_id", "c_circuit_id", gold.width())
    r = spread(r, gold.width(), "race_id").alias("r")
    sd = gold.ref("standings_drivers").alias("sd")
    st = gold.ref("standings_teams").alias("st")
    j = (
        fr.join(r, F.col("fr.race_id") == F.col("r.race_id"))
        .join(sd, (F.col("fr.race_id") == F.col("sd.race_id")) & (F.col("fr.driver_id") == F.col("sd.driver_id")), "left")
        .join(st, (F.col("fr.race_id") == F.col("st.race_id")) & (F.col("fr.team_id") == F.col("st.team_id")), "left")
    )
    late = {}
    for i, (side, key, its) in enumerate(left):  # no shuffle carries their columns
        j = j.join(F.broadcast(side.alias(f"b{i}")), F.col(f"fr.{key}") == F.col(f"b{i}.{its}"))
        late |= {f"fr.{n}": f"b{i}.{n}" for n in side.columns}
    at = lambda src: late.get(src, src)
    return j.select([F.col(at(joined_column(src))).alias(name) for src, name in MASTER_COLUMNS])


#: the dimensions that meet the fact or the race first, and the side that then holds their columns
CARRIED = {"d": "fr.d_", "t": "fr.t_", "c": "r.c_"}


def joined_column(src: str) -> str:
    """Where the joined rows hold a column of ``MASTER_COLUMNS``."""
    side, name = src.split(".")
    return CARRIED.get(side, f"{side}.") + name


def _subset(master: DataFrame, names) -> DataFrame:
    return master.select([F.col(f"`{n}`") for n in names])


def historical_overview(master: DataFrame) -> DataFrame:
    return _subset(master, OVERVIEW_COLUMNS)


def historical_drivers_teams(master: DataFrame) -> DataFrame:
    return _subset(master, DRIVERS_TEAMS_COLUMNS)


def historical_seasons(master: DataFrame) -> DataFrame:
    return _subset(master, SEASON_COLUMNS).distinct()


# (expression or None for NULL, output name, type) of the two kinds of incident
INCIDENT_CELLS = (
    ("race_name", "Race Name", "string"),
    ("incident_type", "Incident Type", "string"),
    ("lap", "Lap", "int"),
    ("incident", "Incident Description", "string"),
    ("deployed_lap", "SC Deployed Lap", "int"),
    ("retreated_lap", "SC Retreated Lap", "double"),
    ("full_laps_under_sc", "Full Laps Under SC", "int"),
    ("resumed", "Resumed", "string"),
    ("excluded", "Excluded Drivers", "string"),
    (None, "Person", "string"),
    (None, "Age", "int"),
    (None, "Date of Accident", "date"),
    (None, "Car", "string"),
    (None, "Session", "string"),
    (None, "Fatal Accident Type", "string"),
)
ACCIDENT_CELLS = (
    ("event", "Race Name", "string"),
    ("'Fatal Accident'", "Incident Type", "string"),
    (None, "Lap", "int"),
    (None, "Incident Description", "string"),
    (None, "SC Deployed Lap", "int"),
    (None, "SC Retreated Lap", "double"),
    (None, "Full Laps Under SC", "int"),
    (None, "Resumed", "string"),
    (None, "Excluded Drivers", "string"),
    ("name", "Person", "string"),
    ("CAST(age AS INT)", "Age", "int"),
    ("date_of_accident", "Date of Accident", "date"),
    ("car", "Car", "string"),
    ("session", "Session", "string"),
    ("type", "Fatal Accident Type", "string"),
)


def cells_sql(cells) -> list[str]:
    return [f"{src or f'CAST(NULL AS {kind})'} AS `{name}`" for src, name, kind in cells]


def historical_incidents(incidents: DataFrame, accidents: DataFrame) -> DataFrame:
    a = incidents.selectExpr(*cells_sql(INCIDENT_CELLS))
    return a.unionByName(accidents.selectExpr(*cells_sql(ACCIDENT_CELLS)))
