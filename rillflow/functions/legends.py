"""Names of land-cover classes, meanings of quality flags, time zones and provinces."""

from __future__ import annotations

# Land-cover classes of the three products.
LEGENDS = {
    "GLCLU 2019": {1: "true_desert", 2: "semi_arid", 3: "dense_short_vegetation", 4: "open_tree_cover", 5: "dense_tree_cover", 6: "tree_cover_gain", 7: "tree_cover_loss", 8: "salt_pan", 9: "wetland_sparse_vegetation", 10: "wetland_dense_short_vegetation", 11: "wetland_open_tree_cover", 12: "wetland_dense_tree_cover", 13: "wetland_tree_cover_gain", 14: "wetland_tree_cover_loss", 15: "ice", 16: "water", 17: "cropland", 18: "built_up", 19: "ocean", 20: "no_data"},
    "MCD12Q1.061": {1: "evergreen_needleleaf_forest", 2: "evergreen_broadleaf_forest", 3: "deciduous_needleleaf_forest", 4: "deciduous_broadleaf_forest", 5: "mixed_forest", 6: "closed_shrubland", 7: "open_shrubland", 8: "woody_savanna", 9: "savanna", 10: "grassland", 11: "permanent_wetland", 12: "cropland", 13: "urban_and_built_up", 14: "cropland_natural_mosaic", 15: "permanent_snow_ice", 16: "barren", 17: "water", 255: "unclassified"},
    "LGRIP30": {0: "water", 1: "non_cropland", 2: "irrigated_cropland", 3: "rainfed_cropland"},
}

# Meanings of the US survey's quality codes.
USA_FLAGS = {
    "nan": "Unknown",
    "A:[0]": "Undefined",
    "A:<": "Approved, but reported value known to be inaccurate (real value is lower)",
    "A:>": "Approved, but reported value known to be inaccurate (real value is higher)",
    "A:[4]": "Approved, but with Incomplete or Partial Aggregated Record",
    "P:[4]": "Provisional, with Incomplete or Partial Aggregated Record",
    "P:e": "Provisional AND estimated",
    "P": "Provisional, not approved",
    "A:R": "Approved, but revised",
    "A:e": "Approved AND estimated, with unknown data grade code",
    "A": "Approved, with unknown data grade code",
    "A:[93]": "Approved, with IV verification DV <= 10 percent diff",
    "A:[92]": "Approved, with IV verification DV <= 5 percent diff",
    "A:[91]": "Approved, with IV verification DV <= 1 percent diff",
    "A:[90]": "Approved, with IV verification DV <= 0.01 orig DV = 0",
}

# Meanings of the Canadian approval:grade codes and of the daily symbols.
CAN_FLAGS = {
    "nan": "Unknown",
    "Provisional/Provisoire:0": "Provisional, flag unknown (not described in WSC docs)",
    "Provisional/Provisoire:40": "Provisional, dry (water level below sensor)",
    "Provisional/Provisoire:10": "Provisional, ice-affected",
    "Provisional/Provisoire:20": "Provisional, estimated",
    "Provisional/Provisoire:30": "Provisional, partial day (relevant only for daily means)",
    "Provisional/Provisoire:nan": "Provisional, no qualifier specified",
    "Provisional/Provisoire:-1": "Provisional, no special conditions",
    "Provisional/Provisoire:50": "Provisional, revised",
    "Final/Finales:0": "Approved, flag unknown (not described in WSC docs)",
    "Final/Finales:40": "Approved, dry (water level below sensor)",
    "Final/Finales:10": "Approved, ice-affected",
    "Final/Finales:20": "Approved, but estimated",
    "Final/Finales:30": "Approved, partial day (relevant only for daily means)",
    "Final/Finales:nan": "Approved, no qualifier specified",
    "Final/Finales:-1": "Approved, no special conditions",
    "Final/Finales:50": "Approved, but revised",
    "nan:0": "Unknown, flag unknown (not described in WSC docs)",
    "nan:40": "Unknown, dry (water level below sensor)",
    "nan:10": "Unknown, ice-affected",
    "nan:20": "Unknown, estimated",
    "nan:30": "Unknown, partial day (relevant only for daily means)",
    "nan:nan": "Unknown, no qualifier specified",
    "nan:-1": "Unknown, no special conditions",
    "nan:50": "Unknown, revised",
    "Preliminary:0": "Provisional, flag unknown (not described in WSC docs)",
    "Preliminary:40": "Provisional, dry (water level below sensor)",
    "Preliminary:10": "Provisional, ice-affected",
    "Preliminary:20": "Provisional, estimated",
    "Preliminary:30": "Provisional, partial day (relevant only for daily means)",
    "Preliminary:nan": "Provisional, no qualifier specified",
    "Preliminary:-1": "Provisional, no special conditions",
    "Preliminary:50": "Provisional, revised",
    "Reviewed:0": "Reviewed, flag unknown (not described in WSC docs)",
    "Reviewed:40": "Reviewed, dry (water level below sensor)",
    "Reviewed:10": "Reviewed, ice-affected",
    "Reviewed:20": "Reviewed, but estimated",
    "Reviewed:30": "Reviewed, partial day (relevant only for daily means)",
    "Reviewed:nan": "Reviewed, no qualifier specified",
    "Reviewed:-1": "Reviewed, no special conditions",
    "Reviewed:50": "Reviewed, but revised",
    "Approved:0": "Approved, flag unknown (not described in WSC docs)",
    "Approved:40": "Approved, dry (water level below sensor)",
    "Approved:10": "Approved, ice-affected",
    "Approved:20": "Approved, but estimated",
    "Approved:30": "Approved, partial day (relevant only for daily means)",
    "Approved:nan": "Approved, no qualifier specified",
    "Approved:-1": "Approved, no special conditions",
    "Approved:50": "Approved, but revised",
    "A": "Partial day",
    "B": "Ice Conditions",
    "D": "Dry",
    "E": "Estimated",
    "S": "Sample(s) collected this day",
}

# Offsets of the time zone codes that gauges report, standard and daylight time.
TIME_ZONES = {"AST": "UTC-04", "CDT": "UTC-05", "CST": "UTC-06", "EDT": "UTC-04", "EST": "UTC-05", "LST": "UTC-09", "MDT": "UTC-06", "MST": "UTC-07", "NST": "UTC-0330", "PDT": "UTC-07", "PST": "UTC-08"}

# Names of the Canadian provinces and territories.
PROVINCES = {"AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick", "NL": "Newfoundland and Labrador", "NS": "Nova Scotia", "NT": "Northwest Territories", "NU": "Nunavut", "ON": "Ontario", "PE": "Prince Edward Island", "QC": "Quebec", "SK": "Saskatchewan", "YT": "Yukon"}

FLAGS = {"USA": USA_FLAGS, "CAN": CAN_FLAGS}
