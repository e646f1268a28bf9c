"""The sample Bronze tables, with their planted faults."""

from datetime import date

from oreworks.model import Combination

PHARMACY = (
    "patient_id string, prescription_date date, drug_name string, quantity int, "
    "days_supply int, prescriber_id string, pharmacy_id string, cost double"
)
MEDICAL = (
    "patient_id string, service_date date, procedure_code string, diagnosis_code string, "
    "provider_id string, facility_id string, charge_amount double, allowed_amount double"
)
MEMBER = (
    "member_id string, enrollment_date date, termination_date date, plan_code string, "
    "subscriber_id string, dependent_number int, gender string, birth_date date"
)

PHARMACY1 = Combination("source1", "lob1", "pharmacy")
MEDICAL1 = Combination("source1", "lob1", "medical")
MEMBER1 = Combination("source1", "lob1", "member")
PHARMACY2 = Combination("source2", "lob3", "pharmacy")
MEMBER2 = Combination("source2", "lob3", "member")

BRONZE = {
    PHARMACY1: (
        PHARMACY,
        [
            ("pat001", date(2024, 7, 1), "Metformin", 90, 30, "dr001", "pharm001", 25.50),
            ("pat002", date(2024, 7, 2), "Lisinopril", 30, 30, "dr001", "pharm001", 15.75),
            ("pat003", date(2024, 7, 3), "Atorvastatin", 30, 30, "dr002", "pharm002", 45.25),
            ("pat001", date(2024, 7, 15), "Insulin", 3, 30, "dr003", "pharm001", 125.00),
            ("pat004", date(2024, 7, 10), "Amlodipine", 30, 30, "dr001", "pharm003", 18.50),
            ("PAT005", date(2024, 7, 12), " Metoprolol ", 60, 30, "dr002", "pharm002", None),
            (None, date(2024, 7, 8), "Omeprazole", 30, 30, "dr001", "pharm001", 22.75),
            ("pat006", date(2024, 7, 20), "Levothyroxine", 90, 90, "dr003", "pharm003", 12.25),
        ],
    ),
    MEDICAL1: (
        MEDICAL,
        [
            ("pat001", date(2024, 7, 5), "99213", "E11.9", "prov001", "fac001", 150.0, 120.0),
            ("pat002", date(2024, 7, 8), "99214", "I10", "prov002", "fac001", 200.0, 160.0),
            ("pat003", date(2024, 7, 12), "99396", "Z00.00", "prov001", "fac002", 250.0, 200.0),
            ("pat001", date(2024, 7, 18), "80053", "E11.9", "prov003", "fac003", 85.0, 68.0),
            ("pat004", date(2024, 7, 22), "99215", "M25.511", "prov002", "fac001", 275.0, 220.0),
            ("PAT005", date(2024, 7, 25), " 99213 ", "I10", "prov001", "fac002", 150.0, None),
            ("pat006", date(2024, 7, 28), "93000", "I49.9", "prov003", "fac003", 75.0, 60.0),
        ],
    ),
    MEMBER1: (
        MEMBER,
        [
            ("mem001", date(2024, 1, 1), None, "HMO001", "sub001", 0, "M", date(1985, 3, 15)),
            ("mem002", date(2024, 1, 1), None, "PPO001", "sub002", 0, "F", date(1978, 8, 22)),
            ("mem003", date(2024, 2, 1), None, "HMO001", "sub001", 1, "F", date(2010, 5, 8)),
            ("mem004", date(2024, 3, 1), date(2024, 6, 30), "EPO001", "sub004", 0, "M", date(1992, 11, 3)),
            ("mem005", date(2024, 4, 1), None, "PPO001", "sub005", 0, "F", date(1965, 7, 18)),
            ("MEM006", date(2024, 5, 1), None, " HMO001 ", "sub001", 2, None, date(2015, 2, 28)),
            ("mem007", date(2024, 6, 1), None, "HMO002", "sub007", 0, "M", date(1988, 9, 12)),
        ],
    ),
    PHARMACY2: (
        PHARMACY,
        [
            ("pat101", date(2024, 7, 1), "Aspirin", 30, 30, "dr101", "pharm101", 8.50),
            ("pat102", date(2024, 7, 2), "Ibuprofen", 60, 30, "dr102", "pharm101", 12.75),
            ("", date(2024, 7, 3), "Acetaminophen", 50, 30, "dr101", "pharm102", 6.25),
            ("pat103", None, "Naproxen", 30, 30, "dr103", "pharm102", 15.50),
        ],
    ),
    MEMBER2: (
        MEMBER,
        [
            ("mem101", date(2024, 1, 1), None, "HMO101", "sub101", 0, "M", date(1980, 1, 15)),
            ("mem102", date(2024, 2, 1), None, "PPO101", "sub102", 0, "F", date(1975, 6, 20)),
            ("mem103", date(2024, 3, 1), None, "EPO101", "sub103", 0, "U", date(1990, 12, 8)),
            ("mem101", date(2024, 1, 1), None, "HMO101", "sub101", 0, "M", date(1980, 1, 15)),
        ],
    ),
}
