"""Values that results depend on, stated once.

Everything in this file is a fixed value: message codes, field names, code
lists, targets and thresholds of the sorter controller's log format.
"""

# ---- Fixed values: log record layout -------------------------------------
LOG_COLUMNS = [
    "timeStamp", "flag", "systemName", "ipAddress", "sender", "unkown", "unkown_2",
    "timeStampPLC", "mainCabinetName", "messageCode", "sequenceNo", "rawMessage",
]
FLAT_EXPORT_COLUMNS = [
    "stamp_raw", "flag", "system", "hostport", "module", "unused1", "unused2", "run_hms",
    "seq", "mc", "code", "sq", "event", "awcsAction", "plcRecordNo", "itemID", "indexNo",
    "awcsStateNow", "awcsStateNew", "inductionStatus", "inductionNo", "destinationNo",
    "carrierNo", "carrierCount", "comHost", "comMode", "telegramType",
]
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- Fixed values: message codes -----------------------------------------
SORT_REPORT_CODE = "54177"
DESTINATION_REQUEST_CODE = "54163"
ITEM_INDUCTED_CODE = "54123"
MEASUREMENT_CODES = ["50102", "50103"]

# ---- Fixed values: payload keys ------------------------------------------
SORT_REPORT_KEYS = [
    "event", "plcRecordNo", "itemID", "indexNo", "locationAWCS", "barcodeAWCS",
    "actualDestMCID", "requestedDestMCID", "sortCode", "requestedDestStatus",
    "comHost", "comMode", "telegramType",
]
SORT_REPORT_KEEP = [
    "timeStamp", "plcRecordNo", "itemID", "indexNo", "locationAWCS", "barcodeAWCS",
    "actualDestMCID", "requestedDestMCID", "sortCode",
]
INDUCTION_KEYS = [
    "event", "awcsAction", "plcRecordNo", "itemID", "indexNo", "awcsStateNow",
    "awcsStateNew", "inductionStatus", "inductionNo", "destinationNo", "carrierNo",
    "carrierCount", "comHost", "comMode", "telegramType",
]
MEASUREMENT_KEYS = ["inductionNo", "length", "width", "positionFront", "noOfCarriers"]

# ---- Fixed values: payload and barcode patterns --------------------------
FRAME_START = "->{"
FRAME_END = "}<"
PAIR_AFTER_COMMA = r",\s*([A-Za-z_]\w*)\s*,\s*([-+]?\d+(?:\.\d+)?)"
PAIR_AT_START = r"^\s*([A-Za-z_]\w*)\s*,\s*([-+]?\d+(?:\.\d+)?)"
NO_READ_BARCODE = r"\?+"
MULTI_READ_BARCODE = r"9+"

# ---- Fixed values: sort codes and defect categories ----------------------
SORT_REASONS = {
    0: "Success",
    1: "Unknown",
    2: "Unexpected_Container",
    3: "Tracking_Error",
    4: "Gap_Error",
    5: "Destination_Full",
    6: "Destination_Non_Operational",
    7: "Invalid_Destination",
    8: "No_Read",
    9: "No_Code",
    10: "Multi_Label",
    11: "<reserved>",
    12: "Destination_Disabled",
    13: "Throughput_Limit",
    14: "Failed_To_Divert",
    15: "<reserved>",
    16: "No_Destination_Received",
    17: "Lost_Container",
    18: "Dimension_Error",
    19: "Weight_Error",
    20: "Container_Utilization",
    21: "Unable_To_Divert",
    22: "Destination_Not_Attempted",
}
DEFECT_CATEGORIES = {
    "Multi_Label": "Scan Defect",
    "No_Read": "Scan Defect",
    "No_Code": "Scan Defect",
    "Failed_To_Divert": "MHE Defect",
    "Gap_Error": "MHE Defect",
    "Destination_Non_Operational": "MHE Defect",
    "Lost_Container": "MHE Defect",
    "No_Destination_Received": "MHE Defect",
    "Unknown": "MHE Defect",
    "Tracking_Error": "MHE Defect",
    "Unable_To_Divert": "MHE Defect",
}
SCAN_DEFECT_CODES = [8, 9, 10]
SCAN_DEFECT_CODES_NOTEBOOK = [8, 10]
RECIRCULATION_IDS = (3000, 3999)
SUCCESS_CHECK_IDS = [159, 76]

# ---- Fixed values: destination mapping columns ---------------------------
MAPPING_ID = "IndexNo"
MAPPING_NAMES = {
    "Amazon": "Amazon_Destination",
    "Beumer": "Beumer_Destination",
    "Jackpot": "Jackpot_Destination",
}

# ---- Fixed values: windows, inductions, targets --------------------------
SESSION_GAP_SECONDS = 1800
WINDOW_MINUTES = 30
LINE_WINDOW_MINUTES = 10
INDUCTION_NAMES = {
    0: "IU001", 1: "IU002", 2: "IU003", 3: "IU004", 4: "IU005", 5: "IU006", 6: "IU007",
    100: "SPS001", 101: "SPS002",
}
NO_INDUCTION_NAME = "No Map Yet"
SEMI_INDUCTIONS = ["IU001", "IU002", "IU003", "IU004"]
AUTO_INDUCTIONS = ["IU005", "IU006", "IU007"]
SPS_INDUCTIONS = ["SPS001", "SPS002"]
TARGET_SINGLE_SEMI = 2640.0
TARGET_SINGLE_AUTO = 2820.0
TARGET_ALL_SEMI = 9119.0 / 4.0
TARGET_ALL_AUTO = 7351.0 / 3.0
TARGET_SPS = 100.0
LINE_TARGET = 2450.0
ADVICE_FORMAT = "Need +%d items in this %.1f min window or reduce sec/bag to ≤ %.2f (current %.2f)."
ADVICE_ON_TARGET = "On target or above. Maintain current rate."
SUMMARY_FORMAT = "%s;Measuring Point: %s: Time %s; Total Inducted = %d"
TOTAL_LINE = "All Inductions"
MEASURING_POINT = "MP1000605"
LINE_NAME = "IU006"

# ---- Fixed values: spacing, gaps, sizes ----------------------------------
BYPASS_DESTINATIONS = [
    "S01aa-S01ad", "S01aa-S01af", "S01aa-S01ah",
    "S01ac-S01ab", "S01ac-S01af", "S01ac-S01ah",
    "S01ae-S01ab", "S01ae-S01ad", "S01ae-S01ah",
    "S01ag-S01ab", "S01ag-S01ad", "S01ag-S01af",
]
SPACING_BIN_SECONDS = 0.28
GAP_EDGES = [0.0, 0.4, 0.8, 1.4, 2.0, 3.0, 5.0, 10.0]
GAP_LABELS = ["0-0.4", "0.4-0.8", "0.8-1.4", "1.4-2", "2-3", "3-5", "5-10", ">10"]
GAP_QUANTILES = [0.5, 0.75, 0.9, 0.95, 0.99]
SIZE_THRESHOLD = 450
SAMPLE_ROWS = 50_000
SAMPLE_SEED = 42

# ---- Fixed values: alarms ------------------------------------------------
PART_PREFIX = "=CBS01."
DEVICE_PATTERNS = {
    "DBS": "DBS[0-9]+", "IAS": "IAS[0-9]+", "ES": "ES[0-9]+", "CHU": "CHU[0-9]+",
}
ESTOP_GROUP = "ES"
CARRIER_ALARMS = ["Item on bellows is active", "Disabled"]
