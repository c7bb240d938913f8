"""Names, texts and formats that results depend on. Nothing here is computed."""

# Envelope and raw table.
RAW_COLUMNS = ("data", "meta_file_name", "meta_file_modified")

# Landing paths, by endpoint.
LANDING_PATHS = {
    "atp_results_archive": "raw/atp_results_archive/incoming/year={year}/atp_calendar_{year}_{timestamp}.json",
    "atp_tournaments": "raw/atp_tournaments/incoming/year={year}/atp_tournaments_{year}_{timestamp}.json",
    "atp_tournament": "raw/atp_tournament/year={year}/tourn={tournament_id}/"
                      "atp_tournament_results_{year}_{tournament_id}_{timestamp}.json",
    "match_stats": "raw/match-stats/year={year}/tourn={tournament_id}/{filename}",
}
GENERIC_LANDING_PATH = "raw/{endpoint}/year={year}/month={month}/{timestamp}.json"
MATCH_FILE_NAME = "{round}_{player1}_{player2}_{match_id}_{data_type}_{timestamp}.json"
TIMESTAMP_FORMAT = "yyyyMMdd_HHmmss"

# Addresses of match data, by type. The first is plain JSON, the others are encrypted.
MATCH_DATA_URLS = {
    "match-info": "{root_url}/-/Hawkeye/MatchStats/Complete/{year}/{tourn_id}/{match_id}",
    "key-stats": "{base_url}/{year}/{tourn_id}/{match_id}/keystats.json",
    "rally-analysis": "{base_url}/{year}/{tourn_id}/{match_id}/rally-analysis.json",
    "stroke-analysis": "{base_url}/{year}/{tourn_id}/{match_id}/stroke-analysis.json",
    "court-vision": "{base_url}/{year}/{tourn_id}/{match_id}/courtvision.json",
}

# Fallback texts.
UNKNOWN_ROUND = "Unknown Round"
UNKNOWN_COUNTRY = "Unknown"
OTHER_CATEGORY = "Other"
BAD_NATION = "-"

# Round names with their own abbreviation.
ROUND_CODES = {
    "Quarterfinals": "QF",
    "Quarter-Finals": "QF",
    "Semifinals": "SF",
    "Semi-Finals": "SF",
    "Final": "F",
    "Finals": "F",
}

# Change tags.
NEWLY_COMPLETED = "newly_completed"
ONGOING = "ongoing"
