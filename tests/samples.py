"""Small raw files in the shapes the jobs read."""

import json
from pathlib import Path

PROJECTS = """project_id,project_name,department,status,start_date,end_date,budget,actual_cost,project_manager_id,priority,region
P1,"Alpha, phase 1",IT,In Progress,2024-01-01,,1000,1200,E1,Low,North
P2,Beta,HR,completed,2024-01-01,2024-02-01,2000,1900,E2,High,South
P3,Gamma,IT,On Hold,2024-03-01,,,50,E1,Critical,North
P4,Delta,HR,Not Started,2024-03-01,,n/a,10,E2,Low,South
P5,Eps,HR,In Progress,2024-03-01,,500,10,E2,Low,South
P6,Zeta,HR,In Progress,2024-03-01,,500,10,E2,Low,South
P7,Eta,HR,In Progress,2024-03-01,,500,10,E2,Low,South
P8,Theta,HR,In Progress,2024-03-01,,500,10,E2,Low,South
P9,Iota,HR,In Progress,2024-03-01,,500,10,E2,Low,South
P10,Kappa,HR,In Progress,2024-03-01,,500,10,E2,Low,South
"""

EMPLOYEES = """employee_id,full_name,email,department,role,level,hire_date,salary,manager_id,region,status,years_experience
E1,Ann Lee,ann.lee@example.com,IT,Dev,Lead,2015-01-01,40000,,North,Active,10
E2,Bo Ray,,HR,Ops,Junior,-999,15000,E1,South,Active,1
E3,Cy Fox,cy@example.com,HR,Ops,Junior,2020-01-01,75000,EMP0000,South,Active,2
E3,Cy Fox,second@example.com,HR,Ops,Junior,2020-01-01,75000,E1,South,Active,2
E4,Di Orr,di@example.com,HR,Ops,Junior,2020-01-01,16000,E1,South,Active,-1
"""

HISTORY = """employee_id,previous_salary,new_salary,previous_role,new_role,previous_level,new_level,effective_date,change_type,change_reason
E2,,14000,,Ops,,Junior,2021-05-01,Hire,start
E2,14000,15000,Ops,Ops,Junior,Junior,2022-05-01,Annual Raise,good
E1,,30000,,Dev,,Senior,2015-01-01,Hire,start
E1,30000,40000,Dev,Dev,Senior,Lead,2020-01-01,Promotion,great
"""

TRANSACTIONS = [
    {"transaction_id": "T1", "project_id": "P1", "vendor_id": "V1", "vendor_name": "Acme",
     "category": "Software", "amount": 100.5, "currency": "AED", "transaction_date": "2024-01-15",
     "approved_by": "E1", "payment_status": "Paid", "invoice_ref": "I1", "notes": None},
    {"transaction_id": "T2", "project_id": "P1", "vendor_id": "V2", "vendor_name": "Bolt",
     "category": "Travel", "amount": None, "currency": "AED", "transaction_date": "2019-02-15",
     "approved_by": "E1", "payment_status": "Pending", "invoice_ref": "I2", "notes": "x"},
    {"transaction_id": "T3", "project_id": "P2", "vendor_id": "V1", "vendor_name": "Acme",
     "category": "Software", "amount": "70", "currency": "AED", "transaction_date": "2024-03-15",
     "approved_by": None, "payment_status": "Disputed", "invoice_ref": "I3"},
    {"transaction_id": "T4", "project_id": "P2", "vendor_id": "V1", "vendor_name": "Acme",
     "category": "Travel", "amount": "oops", "currency": "AED", "transaction_date": "soon",
     "approved_by": "E2", "payment_status": "Paid", "invoice_ref": "I4", "notes": "y"},
]

EVENTS = [
    {"event_id": "e1", "event_type": "escalation_raised", "project_id": "P1", "user_id": "u1",
     "timestamp": "2025-01-11T12:00:00Z", "payload": {"severity": "Critical"}},
    {"event_id": "e2", "event_type": "escalation_resolved", "project_id": "P1", "user_id": "u2",
     "timestamp": "2025-01-11T13:30:00Z", "payload": {"resolved_by": "u2"}},
    {"event_id": "e3", "event_type": "login", "project_id": None, "user_id": "u1",
     "timestamp": "2025-01-12T08:00:00Z", "payload": {}},
    {"event_id": "e4", "event_type": "escalation_raised", "project_id": "P2", "user_id": "u1",
     "timestamp": "2025-02-01T00:00:00Z", "payload": {"severity": "Low"}},
    {"event_id": "e4", "event_type": "escalation_raised", "project_id": "P2", "user_id": "u1",
     "timestamp": "2025-02-01T00:10:00Z", "payload": {"severity": "Low"}},
    {"event_id": "e5", "project_id": "P2", "user_id": "u3", "timestamp": "2025-02-01T00:00:00Z"},
]


def write_all(folder: Path) -> dict[str, str]:
    paths = {}
    for name, text in (("projects", PROJECTS), ("employees", EMPLOYEES), ("history", HISTORY)):
        paths[name] = str(folder / f"{name}.csv")
        Path(paths[name]).write_text(text, encoding="utf-8")
    paths["transactions"] = str(folder / "transactions.json")
    Path(paths["transactions"]).write_text(json.dumps(TRANSACTIONS), encoding="utf-8")
    events = folder / "events"
    events.mkdir()
    january = [json.dumps(e) for e in EVENTS[:3]]
    february = [json.dumps(e) for e in EVENTS[3:]]
    (events / "events_2025_01.jsonl").write_text("\n".join(january) + "\n\n", encoding="utf-8")
    (events / "events_2025_02.jsonl").write_text(
        "\n".join([*february, "{broken"]) + "\n", encoding="utf-8"
    )
    paths["events"] = str(events)
    return paths
