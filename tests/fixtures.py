"""Synthetic raw CSV inputs with the edge rows each semantic rule needs.

Files are UTF-8, CRLF, comma separated, with a header and one extra trailing
``source`` column, like the real exports. Expected gold rows were computed by
hand from these rows (see the comments).
"""

from __future__ import annotations

import os

HEADERS = {
    "circuits": "circuitId,circuitRef,name,location,country,lat,lng,alt,url,source",
    "constructors": "constructorId,constructorRef,name,nationality,url,source",
    "status": "statusId,status,source",
    "drivers": "driverId,driverRef,number,code,forename,surname,dob,nationality,source",
    "races": "raceId,year,round,circuitId,name,date,time,url,source",
    "results": ("resultId,raceId,driverId,constructorId,number,grid,position,positionText,"
                "positionOrder,points,laps,time,milliseconds,fastestLap,rank,fastestLapTime,"
                "fastestLapSpeed,statusId,source"),
    "driver_standings": ("driverStandingsId,raceId,driverId,points,position,positionText,wins,"
                         "source"),
}

ROWS = {
    "circuits": [
        '1,north_loop,North Loop,Harbour,Eastland,-1.5,2.25,10,'
        '"http://example.org/loops/Harbour,_North",fx',                # quoted comma
        "2,sul,Autódromo do Sul,São Pedro,Westland,3.5,-4.75,NULL,"
        "http://example.org/sul,fx",                                   # non-ASCII, alt NULL
        "x,bogus,Bogus,Nowhere,Nowhere,0,0,0,http://example.org/bogus,fx",  # bad key
    ],
    "constructors": [
        "1,ferrari,Ferrari,Italian,http://example.org/f,fx",
        "2,mclaren,McLaren,British,http://example.org/m,fx",
        "3,williams,Williams,British,http://example.org/w,fx",
    ],
    "status": [
        "1,Finished,fx", "4,Accident,fx", "11,+1 Lap,fx", "12,+12 Laps,fx",
        "141,Lapped,fx", "142,Did not start,fx",
    ],
    "drivers": [
        "1,senna,\\N,SEN,Ayrton,Senna,1960-03-21,Brazilian,fx",
        "2,prost,\\N,PRO,Alain,Prost,1955-02-24,French,fx",
        "3,mansell,5,MAN,,Mansell,1953-08-08,British,fx",              # null forename
        "4,berger,\\N,BER,Gerhard,Berger,1959-08-27,Austrian,fx",
        "5,alesi,\\N,ALE,Jean,Alesi,1964-06-11,French,fx",
        "6,hill,\\N,HIL,Damon,Hill,1960-09-17,British,fx",
        "7,villeneuve,\\N,VIL,Jacques,Villeneuve,1971-04-09,Canadian,fx",
        "8,irvine,\\N,\\N,Eddie,Irvine,1965-11-10,British,fx",          # no results
    ],
    "races": [
        "101,2001,1,1,Race A,2001-03-04,\\N,http://example.org/101,fx",
        "102,2001,2,2,Race B,2001-04-01,06:00:00,http://example.org/102,fx",
        "201,2002,1,1,Race A,2002-03-03,\\N,http://example.org/201,fx",
        "202,2002,2,2,Race B,2002-04-07,\\N,http://example.org/202,fx",
        "301,2003,1,1,Race A,2003-03-09,\\N,http://example.org/301,fx",
        "401,2004,1,1,Race A,2004-03-07,\\N,http://example.org/401,fx",
    ],
}


def _result(rid, race, driver, team, order, points, status, position=None, text=None,
            millis="\\N"):
    position = str(order) if position is None else position
    text = position if text is None else text
    return (f"{rid},{race},{driver},{team},\\N,1,{position},{text},{order},{points},50,\\N,"
            f"{millis},\\N,\\N,\\N,\\N,{status},fx")


ROWS["results"] = [
    # 2001: two Ferrari drivers in race 101; Senna twice in race 102
    _result(1001, 101, 1, 1, 1, 10, 1),
    _result(1002, 101, 2, 1, 2, 6, 11),
    _result(1003, 101, 3, 3, 3, 0, 4, position="\\N", text="R"),
    _result(1004, 102, 1, 1, 1, 10, 12, millis="5690616"),
    _result(1005, 102, 1, 1, 4, 0, 141),
    # 2002: an unparsable positionOrder and an unknown status
    _result(2001, 201, 2, 1, 1, 10, 1),
    _result(2002, 201, 5, 2, 2, 6, 1),
    _result(2003, 202, 2, 1, "x", 8, 999, position="\\N", text="D"),
    # 2003: McLaren and Williams tie on points
    _result(3001, 301, 5, 2, 1, 10, 1),
    _result(3002, 301, 3, 3, 2, 10, 1),
    _result(3003, 301, 4, 1, 3, 6, 1),
    # 2004: unknown driver 99; unknown race 999 with unknown constructor 77
    _result(4001, 401, 1, 1, 1, 10, 1),
    _result(4002, 401, 99, 2, 2, 6, 1),
    _result(4003, 999, 3, 77, 1, 10, 1),
    _result(5001, 999, 6, 77, 1, 10, 1),
    _result(5002, 999, 7, 77, 1, 10, 1),
    _result(5003, 999, 7, 77, 1, 5, 1),
    _result(5004, 999, 6, 77, 1, 10, 1),
]

ROWS["driver_standings"] = [
    "1,101,2,6,1,1,0,fx",      # an earlier round's leader
    "2,101,1,10,2,2,1,fx",
    "3,102,1,20,1,1,2,fx",     # 2001 champion: last round, position 1
    "4,102,2,6,2,2,0,fx",
    "5,202,2,24,1,1,1,fx",     # 2002: two drivers at position 1
    "6,202,5,24,1,1,0,fx",
    "7,301,5,10,2,2,1,fx",     # 2003: no position 1 in the last round
    "8,401,1,30,1,1,3,fx",     # 2004 champion
    "9,999,3,10,1,1,1,fx",     # unknown race: race id lost
]


# Columns of each file that hold keys (0-based), without the status codes.
KEYS = {"circuits": [0], "constructors": [0], "drivers": [0], "races": [0, 3],
        "results": [0, 1, 2, 3], "driver_standings": [0, 1, 2], "status": []}


def _shift(entity: str, row: str, by: int) -> str:
    parts = row.split(",")
    for i in KEYS[entity]:
        if parts[i].isdigit():
            parts[i] = str(int(parts[i]) + by)
    return ",".join(parts)


def write_fixtures(root: str, swap_header_of: str | None = None, add_to_keys: int = 0) -> str:
    os.makedirs(root, exist_ok=True)
    for entity, header in HEADERS.items():
        if entity == swap_header_of:
            cols = header.split(",")
            cols[0], cols[1] = cols[1], cols[0]
            header = ",".join(cols)
        rows = [_shift(entity, row, add_to_keys) for row in ROWS[entity]]
        with open(os.path.join(root, f"{entity}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write("\r\n".join([header, *rows]) + "\r\n")
    return root


# ---- hand-computed gold ------------------------------------------------------------
GOLD = {
    "constructor_standings": [
        # race_year, constructor_id, name, total_points, wins, podiums, season_rank
        (2001, 1, "Ferrari", 26.0, 2, 3, 1), (2001, 3, "Williams", 0.0, 0, 1, 2),
        (2002, 1, "Ferrari", 18.0, 1, 1, 1), (2002, 2, "McLaren", 6.0, 0, 1, 2),
        (2003, 2, "McLaren", 10.0, 1, 1, 1), (2003, 3, "Williams", 10.0, 0, 1, 1),
        (2003, 1, "Ferrari", 6.0, 0, 1, 2),
        (2004, 1, "Ferrari", 10.0, 1, 1, 1), (2004, 2, "McLaren", 6.0, 0, 1, 2),
    ],
    "constructor_dominance": [(1, "Ferrari", 2001, 2002, 2)],
    "constructor_career": [
        (1, "Ferrari", "Italian", 60.0, 4, 6, 2001, 2004),
        (2, "McLaren", "British", 22.0, 1, 3, 2002, 2004),
        (3, "Williams", "British", 10.0, 0, 2, 2001, 2003),
    ],
    "driver_career": [
        (1, "Ayrton Senna", "Brazilian", 30.0, 3, 3, 3, 2001, 2004),
        (2, "Alain Prost", "French", 24.0, 1, 2, 3, 2001, 2002),
        (3, "Mansell", "British", 20.0, 1, 3, 3, 2001, 2003),
        (4, "Gerhard Berger", "Austrian", 6.0, 0, 1, 1, 2003, 2003),
        (5, "Jean Alesi", "French", 16.0, 1, 2, 2, 2002, 2003),
        (6, "Damon Hill", "British", 20.0, 2, 2, 1, None, None),
        (7, "Jacques Villeneuve", "Canadian", 15.0, 2, 2, 1, None, None),
    ],
    "season_champions": [
        (2001, 1, "Ayrton Senna", 20.0), (2002, 2, "Alain Prost", 24.0),
        (2002, 5, "Jean Alesi", 24.0), (2004, 1, "Ayrton Senna", 30.0),
    ],
    "drivers_without_title": [
        (6, "Damon Hill", 2, 20.0, 1), (7, "Jacques Villeneuve", 2, 15.0, 1),
        (3, "Mansell", 1, 20.0, 3),
    ],
}
