"""Declared columns of the marts.

Fixed values: names, types and order are the interface of the files read and
the tables written.
"""

from __future__ import annotations

SONG_FILE = (
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)

# Activity log lines as they are on disk: ts in epoch milliseconds, userId as text.
LOG_FILE = (
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, "
    "ts bigint, userAgent string, userId string"
)

# The same lines staged: ts as a timestamp.
STAGED_LOG = LOG_FILE.replace("ts bigint", "ts timestamp_ntz")

# The event CSV files; numbers may be in scientific notation.
EVENT_CSV = (
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, "
    "ts double, userId int"
)
EVENT_COLUMNS = (
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
)

SONG_PLAY = "NextSong"

# Star schema, referenced tables first.
STAR = {
    "users": "user_id string, first_name string, last_name string, gender string, level string",
    "songs": "song_id string, title string, artist_id string, year int, duration double",
    "artists": "artist_id string, name string, location string, latitude double, longitude double",
    "time": (
        "start_time timestamp_ntz, hour int, day int, week int, month int, year int, weekday int"
    ),
    "songplays": (
        "songplay_id bigint, start_time timestamp_ntz, user_id string, level string, "
        "song_id string, artist_id string, session_id int, location string, user_agent string"
    ),
}

# Tables laid out for one question each: columns, partition key, clustering key.
QUERY_FIRST = {
    "session_history": (
        "sessionId int, itemInSession int, artist string, song string, length float",
        ("sessionId",),
        ("itemInSession",),
    ),
    "song_for_user": (
        "userId int, sessionId int, itemInSession int, firstName string, lastName string, "
        "artist string, song string",
        ("userId", "sessionId"),
        ("itemInSession",),
    ),
    "user_for_song": (
        "song string, userId int, firstName string, lastName string",
        ("song",),
        ("userId",),
    ),
}

# Immigration fact: the source columns kept, those made integers, those made dates.
ARRIVAL_COLUMNS = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94port",
    "arrdate", "i94mode", "depdate", "i94visa", "gender", "airline",
)
ARRIVAL_INTS = (
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "i94mode", "i94visa", "arrdate", "depdate",
)
ARRIVAL_DATES = ("arrdate", "depdate")

DATE_PARTS = ("day", "month", "year", "week", "weekday", "yearday")

AIRPORT_COLUMNS = ("name", "iso_country", "iso_region", "municipality", "iata_code")

# City demographics: one line per city and race.
CITY_COLUMNS = (
    "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
    "Number of Veterans", "Foreign-born", "Average Household Size", "State Code",
)
RACES = {
    "American Indian and Alaska Native": "american_indian_and_alaska_native",
    "Asian": "asian",
    "Black or African-American": "black_or_africanamerican",
    "Hispanic or Latino": "hispanic_latino",
    "White": "white",
}
STATE_MEANS = {"Median Age": "median_age", "Average Household Size": "average_household_size"}
STATE_SUMS = {
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Number of Veterans": "number_of_veterans",
    "Foreign-born": "foreignborn",
}

# Immigration mart, in the column order of its files.
IMMIGRATION_MART = {
    "i94": (
        "cicid int, i94yr int, i94mon int, i94cit int, i94res int, i94port string, arrdate date, "
        "i94mode int, depdate date, i94visa int, gender string, airline string, "
        "airport_name string, state_code string, born_country string, residence_country string, "
        "mode string, visa string"
    ),
    "date": "date date, day int, month int, year int, week int, weekday int, yearday int",
    "us_states_temperature": "state string, average_temperature double",
    "world_temperature": "country string, average_temperature double",
    "airport": "name string, iso_country string, municipality string, iata_code string, state string",
    "demographic": (
        "state string, state_code string, median_age double, male_population double, "
        "female_population double, total_population double, number_of_veterans double, "
        "foreignborn double, average_household_size double, "
        "american_indian_and_alaska_native double, asian double, black_or_africanamerican double, "
        "hispanic_latino double, white double"
    ),
}
