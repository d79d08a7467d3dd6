"""Tiny source documents (FIXTURES.md §4), written pretty-printed like the API's."""

import json
from pathlib import Path


def game(pk, date_time, away, home, away_score=None, home_score=None):
    def side(team, score):
        s = {"team": {"id": team, "name": f"T{team}"}}
        if score is not None:
            s["score"] = score
        return s

    return {"gamePk": pk, "gameDate": date_time, "teams": {"away": side(away, away_score), "home": side(home, home_score)}}


def schedule(field):
    shared = game(2020020001, "2021-03-01T23:00:00Z", 1, 2, 3, 2)
    return {
        "teams": [
            {"id": 1, field: {"dates": [{"date": "2021-03-01", "games": [shared]}]}},
            {"id": 2, field: {"dates": [{"date": "2021-03-01", "games": [shared]}]}},
            {"id": 3},  # no schedule at all
            {
                "id": 4,
                field: {"dates": [{"date": "2021-03-02", "games": [game(2020020002, "2021-03-03T02:30:00Z", 4, 1, 5)]}]},
            },
        ]
    }


ROSTER = {
    "teams": [
        {
            "id": 1,
            "roster": {
                "roster": [
                    {"person": {"id": 10, "fullName": "Ann One"}, "jerseyNumber": "9", "position": {"name": "Center"}},
                    {"person": {"id": 11, "fullName": "Bo: Two, Jr."}, "position": {"name": "Goalie"}},
                ]
            },
        },
        {"id": 2, "roster": {"roster": []}},
        {"id": 24, "roster": {"roster": [
            {"person": {"id": 12, "fullName": "Cy"}, "jerseyNumber": "4", "position": {"name": "Defenseman"}}]}},
    ]
}

TEAMS = {
    "teams": [
        {"id": 1, "name": "Alpha Club", "abbreviation": "ALP", "teamName": "Club", "locationName": "Alpha"},
        {"id": 2, "name": "Beta: Team, Ltd", "abbreviation": "BET", "teamName": "Team", "locationName": "Beta"},
        {"id": 3, "abbreviation": "GAM", "teamName": "Gammas", "locationName": "Gamma"},
    ]
}


def stat(gp, w, l, ot, pts, gpg, gapg):
    return {"gamesPlayed": gp, "wins": w, "losses": l, "ot": ot, "pts": pts, "goalsPerGame": gpg,
            "goalsAgainstPerGame": gapg}


STATS = {
    "teams": [
        {
            "id": 1,
            "division": {"name": "Central"},
            "conference": {"name": "Western"},
            "teamStats": [{"splits": [
                {"stat": stat(10, 6, 3, 1, 13, 3.1, 2.5), "team": {"id": 1}},
                {"stat": stat(10, "3rd", "20th", "5th", "7th", "2nd", "9th"), "team": {"id": 1}},
            ]}],
        },
        {
            "id": 2,
            "division": {"name": "Atlantic"},
            "conference": {"name": "Eastern"},
            "teamStats": [{"splits": [{"stat": stat(10, 2, 8, 0, 4, 1.9, 3.8), "team": {"id": 2}}]}],
        },
        {"id": 3, "division": {"name": "Pacific"}, "conference": {"name": "Western"}, "teamStats": [{"splits": []}]},
    ]
}


def write(folder, name, doc):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(doc, indent=2))
    return str(path)


def write_all(folder):
    return {
        "schedule_previous": write(folder, "prev/doc.json", schedule("previousGameSchedule")),
        "schedule_next": write(folder, "next/doc.json", schedule("nextGameSchedule")),
        "roster": write(folder, "roster/doc.json", ROSTER),
        "teams": write(folder, "teams/doc.json", TEAMS),
        "stats": write(folder, "stats/doc.json", STATS),
    }
