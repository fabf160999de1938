"""The event columns beyond the core ones: where a provider file has them, and how the stand-in fills them.

Each is (column, type, path in a provider event, SQL over the core event columns). The SQL is read by
Spark and DuckDB alike; a path whose first part is an event family is only there for its events.
"""

from __future__ import annotations

from typing import NamedTuple


class EventColumn(NamedTuple):
    name: str
    type: str
    path: str
    sql: str


def _one_of(family: str, divisor: int, *names: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE WHEN type_name = '{family}' THEN CASE event_id % {divisor} {cases} END END"


def _flag(family: str, divisor: int) -> str:
    return f"CASE WHEN type_name = '{family}' THEN event_id % {divisor} = 0 END"


#: Event types that share the twentieth of the events that is of none of the frequent types.
RARE_TYPES = ("Block", "Goal Keeper", "Foul Committed", "Foul Won", "Dribble", "Dispossessed", "Miscontrol", "Ball Recovery", "Substitution",
              "Tactical Shift", "Starting XI", "Offside", "Shield", "Camera On", "Bad Behaviour")

RARE_TYPE_SQL = "CASE event_id % 15 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(RARE_TYPES)) + " END"

#: Provider name of the part of an event that holds each family's fields.
FAMILIES = {"shot": "Shot", "pass": "Pass", "goalkeeper": "Goal Keeper", "foul_committed": "Foul Committed", "interception": "Interception",
            "clearance": "Clearance", "bad_behaviour": "Bad Behaviour"}

EXTRA = (
    EventColumn("timestamp", "string", "timestamp",
                "concat('00:', lpad(CAST(minute % 60 AS STRING), 2, '0'), ':', lpad(CAST(second AS STRING), 2, '0'), '.000')"),
    EventColumn("possession", "bigint", "possession", "CAST(floor(event_index / 4) AS BIGINT)"),
    EventColumn("possession_team_id", "bigint", "possession_team.id", "team_id"),
    EventColumn("possession_team_name", "string", "possession_team.name", "team_name"),
    EventColumn("play_pattern_name", "string", "play_pattern.name",
                "CASE event_id % 4 WHEN 0 THEN 'Regular Play' WHEN 1 THEN 'From Corner' WHEN 2 THEN 'From Free Kick' ELSE 'From Counter' END"),
    EventColumn("position_name", "string", "position.name", "concat('P', CAST(player_id % 11 AS STRING))"),
    EventColumn("off_camera", "boolean", "off_camera", "event_id % 31 = 0"),
    EventColumn("out", "boolean", "out", "event_id % 23 = 0"),
    EventColumn("shot_technique", "string", "shot.technique.name", _one_of("Shot", 3, "Normal", "Volley", "Half Volley")),
    EventColumn("shot_first_time", "boolean", "shot.first_time", _flag("Shot", 5)),
    EventColumn("shot_one_on_one", "boolean", "shot.one_on_one", _flag("Shot", 7)),
    EventColumn("shot_end_x", "double", "shot.end_location[0]", "CASE WHEN type_name = 'Shot' THEN end_x END"),
    EventColumn("shot_end_y", "double", "shot.end_location[1]", "CASE WHEN type_name = 'Shot' THEN end_y END"),
    EventColumn("pass_angle", "double", "pass.angle", "CASE WHEN type_name = 'Pass' THEN ((event_id * 31) % 629) / 100.0e0 END"),
    EventColumn("pass_height", "string", "pass.height.name", _one_of("Pass", 3, "Ground Pass", "Low Pass", "High Pass")),
    EventColumn("pass_recipient_id", "bigint", "pass.recipient.id",
                "CASE WHEN type_name = 'Pass' AND pass_outcome IS NULL THEN team_id * 1000 + event_id % 11 END"),
    EventColumn("pass_recipient_name", "string", "pass.recipient.name",
                "CASE WHEN type_name = 'Pass' AND pass_outcome IS NULL THEN concat('Player ', CAST(team_id * 1000 + event_id % 11 AS STRING)) END"),
    EventColumn("pass_body_part", "string", "pass.body_part.name", _one_of("Pass", 2, "Left Foot", "Right Foot")),
    EventColumn("pass_xa", "double", "pass.xa", "CASE WHEN type_name = 'Pass' AND pass_shot_assist THEN (event_id % 50) / 100.0e0 END"),
    EventColumn("pass_switch", "boolean", "pass.switch", _flag("Pass", 19)),
    EventColumn("pass_through_ball", "boolean", "pass.through_ball", _flag("Pass", 21)),
    EventColumn("goalkeeper_type", "string", "goalkeeper.type.name", _one_of("Goal Keeper", 2, "Shot Faced", "Collected")),
    EventColumn("goalkeeper_outcome", "string", "goalkeeper.outcome.name", _one_of("Goal Keeper", 4, "Success", "Claim", "Touched Out")),
    EventColumn("goalkeeper_position", "string", "goalkeeper.position.name", _one_of("Goal Keeper", 3, "Set", "Moving", "Prone")),
    EventColumn("goalkeeper_body_part", "string", "goalkeeper.body_part.name", _one_of("Goal Keeper", 2, "Both Hands", "Chest")),
    EventColumn("goalkeeper_technique", "string", "goalkeeper.technique.name", _one_of("Goal Keeper", 2, "Diving", "Standing")),
    EventColumn("foul_card", "string", "foul_committed.card.name", _one_of("Foul Committed", 5, "Yellow Card", "Red Card", "Second Yellow")),
    EventColumn("foul_penalty", "boolean", "foul_committed.penalty", _flag("Foul Committed", 4)),
    EventColumn("interception_outcome", "string", "interception.outcome.name", _one_of("Interception", 3, "Won", "Lost Out", "Success In Play")),
    EventColumn("clearance_body_part", "string", "clearance.body_part.name", _one_of("Clearance", 3, "Head", "Left Foot", "Right Foot")),
    EventColumn("clearance_head", "boolean", "clearance.head", _flag("Clearance", 3)),
    EventColumn("bad_behaviour_card", "string", "bad_behaviour.card.name", _one_of("Bad Behaviour", 2, "Yellow Card", "Red Card")),
)
