"""Configuration-as-data: scheduling constants and small literal dictionaries.

Everything here is bounded by construction (tens of entries); lookups use
literal CASE expressions or explicitly broadcast literal frames.
"""

from __future__ import annotations

# --- fixed values: scheduling and scoring constants ---
TTL_HOURS = {"HIGH": 8, "MED": 24, "LOW": 48}
CADENCE_BOUNDS_H = {"HIGH": (8, 24), "MED": (24, 72), "LOW": (48, 144)}
CADENCE_STEP_H = {"HIGH": 8, "MED": 24, "LOW": 48}
TIER_RANK = {"HIGH": 1, "MED": 2}  # anything else ranks 3
PROMOTE_TO_MED = 3
PROMOTE_TO_HIGH = 10
DEMAND_HALF_LIFE_DAYS = 14.0
CHANGE_RATE_ALPHA = 0.3
CHANGE_RATE_SEED = 0.5
DEMAND_REF = 10.0
SCORE_W_DEMAND = 0.5
SCORE_W_OVERDUE = 0.3
SCORE_W_CHANGE = 0.2
SCORE_FETCH_MULTIPLE = 4
CASH_TTL_HOURS = 72
MATCH_TOLERANCE_MIN = 10
BLOCK_COOLDOWN_MIN = 30
CABINS = ("economy", "premium_economy", "business", "first")
# cash-site carrier display name -> award program IATA code
CARRIER_TO_IATA = {
    "Alaska": "AS",
    "Delta": "DL",
    "JetBlue": "B6",
    "Turkish Airlines": "TK",
    "Etihad": "EY",
    "Southwest": "WN",
}
CASH_SOURCE = "meta_search"  # provenance stamp of matched cash rows
OD_SENTINEL = "__OD__"
UNKNOWN_FLIGHT = "UNKNOWN"
# --- end fixed values ---

# --- fixed values: metro areas (token -> airports, in listed order) ---
METROS = {
    "NYC": ("JFK", "EWR", "LGA"), "LAX_METRO": ("LAX", "BUR", "SNA", "ONT", "LGB"), "BAY": ("SFO", "OAK", "SJC"),
    "WAS": ("DCA", "IAD", "BWI"), "CHI": ("ORD", "MDW"), "HOU_METRO": ("IAH", "HOU"), "DAL_METRO": ("DFW", "DAL"),
    "SOUTH_FLORIDA": ("MIA", "FLL", "PBI"), "LON": ("LHR", "LGW"), "PAR": ("CDG", "ORY"), "TYO": ("HND", "NRT"),
}
# --- end fixed values ---
