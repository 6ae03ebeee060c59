"""Spellings, lookup values and score constants.

Everything in this module is a fixed value: results are only right when these
texts and numbers are exactly as stated.
"""

# Missing-value texts recognised in CSV files and workbooks (fixed values).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Boolean spellings, upper-cased (fixed values).
TRUE_WORDS = (
    "TRUE", "1", "Y", "YES", "H", "HAI", "HAAN", "WORKING", "FUNCTIONAL", "AVAILABLE",
)
FALSE_WORDS = (
    "FALSE", "0", "N", "NO", "NAHI", "NAHI HAI", "NA", "KHARAB", "BROKEN",
    "UNDER REPAIR", "NOT AVAILABLE",
)

# Roman class numbers for grades 1 to 12 (fixed values).
ROMAN_GRADES = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII")

# Category spellings, upper-cased, to the reported name (fixed values).
GRAINS = {
    "RICE": "Rice", "CHAWAL": "Rice", "RICE/CHAWAL": "Rice",
    "WHEAT": "Wheat", "GEHUN": "Wheat", "ATTA": "Wheat",
    "DAL": "Pulses", "DAAL": "Pulses", "PULSES": "Pulses", "LENTILS": "Pulses",
    "MUSTARD OIL": "Oil", "SARSON TEL": "Oil", "OIL": "Oil", "COOKING OIL": "Oil",
}
OTHER_GRAIN = "Other"

VENDORS = {
    "KUMAR & CO.": "Kumar Enterprises",
    "KUMAR GENERAL STORE": "Kumar Enterprises",
    "KUMAR SUPPLIES": "Kumar Enterprises",
    "SINGH BROTHERS": "Singh Agro Group",
    "SINGH AGRO": "Singh Agro Group",
    "S. AGRO WORKS": "Singh Agro Group",
    "SHARMA & SONS": "Sharma Traders",
    "SHARMA TRADERS PVT LTD": "Sharma Traders",
    "SHARMA TRADERS": "Sharma Traders",
    "GOYAL ENTERPRISES": "Goyal Mills",
    "GOYAL MILL": "Goyal Mills",
    "GOYAL RICE MILL": "Goyal Mills",
}

SUBJECTS = {
    "MATH": "Mathematics", "MATHEMATICS": "Mathematics", "GANIT": "Mathematics",
    "HINDI": "Hindi", "ENGLISH": "English", "PUNJABI": "Punjabi",
    "EVS": "EVS", "SCIENCE": "Science",
}

PAYMENTS = {"PAID": "Paid", "CLEARED": "Paid", "PENDING": "Pending", "DUE": "Pending"}
UNKNOWN_PAYMENT = "Unknown"

# Unit spellings, lower-cased (fixed values).
KILOGRAM_UNITS = ("kg", "kgs", "kilogram", "kilograms")
GRAM_UNITS = ("g", "gram", "grams")
BAG_UNITS = ("50kg bags", "bags", "sacks", "bori", "bag", "sack")

# Currency marks removed from cost text, in this order (fixed values).
CURRENCY_MARKS = ("₹", "Rs.", "Rs", "/-", ",")

# Percentages given to letter grades, and the CGPA factor (fixed values).
LETTER_GRADES = {"A+": 95.0, "A": 85.0, "B": 75.0, "C": 65.0, "D": 55.0, "E": 45.0, "F": 35.0}
CGPA_FACTOR = 9.5
PERCENT_SCALES = ("pct", "%", "percentage")

# Amenities inspected at each school (fixed values).
AMENITIES = (
    "has_electricity", "has_drinking_water", "has_functional_toilet",
    "has_boundary_wall", "has_playground",
)

# Formal report headings by column name (fixed values).
FORMAL_LABELS = {
    "district": "District Name",
    "block": "Block Name",
    "school_id": "School Identifier",
    "school_name": "School Name",
    "school_type": "School Type / Level",
    "medium": "Instruction Medium",
    "total_enrolled_students": "Total Student Enrollment",
    "month": "Academic Month",
    "attendance_date": "Attendance Date",
    "procurement_date": "Procurement Date",
    "assessment_date": "Assessment Date",
    "last_inspection_date": "Last Inspection Date",
    "grade": "Grade / Class Level",
    "subject": "Academic Subject",
    "total_students": "Enrolled Class Students",
    "present_students": "Present Student Count",
    "attendance_rate": "Average Daily Attendance Rate (%)",
    "avg_attendance": "Average Daily Attendance Rate (%)",
    "avg_attendance_rate": "Average Daily Attendance Rate (%)",
    "proxy_anomaly_rate": "Proxy Attendance Anomaly Rate (%)",
    "proxy_anomaly_rate_pct": "Proxy Attendance Anomaly Rate (%)",
    "proxy_anomaly_records": "Proxy Anomaly Record Count",
    "impossible_records": "Impossible Attendance Record Count",
    "teacher_present": "Teacher Attendance Status",
    "marked_by": "Attendance Marking Authority",
    "data_quality_status": "Data Quality Audit Status",
    "vendor_name": "MDM Supplier Entity Name",
    "grain_type": "Food Grain Commodity",
    "quantity_kg": "Procurement Quantity (KG)",
    "total_quantity_kg": "Total Procurement Quantity (KG)",
    "total_cost": "Total Procurement Expenditure (₹)",
    "total_cost_rs": "Total Procurement Expenditure (₹)",
    "cost_per_kg": "Unit Cost Efficiency (₹/KG)",
    "payment_status": "Supplier Payment Status",
    "electricity_status": "Electricity Facility Status",
    "has_electricity": "Electricity Availability Status",
    "has_drinking_water": "Drinking Water Availability Status",
    "has_functional_toilet": "Functional Toilet Availability Status",
    "has_boundary_wall": "Boundary Wall Security Status",
    "has_playground": "Playground Facility Status",
    "infrastructure_score": "Infrastructure Health Score (%)",
    "infrastructure_deficit_pct": "Infrastructure Deficit Index (%)",
    "avg_infra_deficit": "Infrastructure Deficit Index (%)",
    "deficit": "Infrastructure Deficit Index (%)",
    "grading_scale_raw": "Ingested FLN Grading Scale",
    "avg_score_raw": "Raw Score Record",
    "score_percentage": "Standardized FLN Score (%)",
    "avg_fln_score": "Average FLN Test Score (%)",
    "fln_score": "Average FLN Test Score (%)",
    "assessment_count": "Total Assessments Evaluated",
    "welfare_risk_score": "Welfare & Retention Risk Index (0-100)",
    "welfare_risk_category": "Welfare Risk Classification",
    "school_count": "School Count",
    "total_schools": "Total Reporting Schools",
    "total_records": "Total Transaction Records",
    "sunday_anomaly_count": "Sunday Proxy Marking Record Count",
}
