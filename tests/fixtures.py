"""Hand-written CSV deliveries covering the ingestion edge cases."""

from __future__ import annotations

import os

SALES_HEADER = "store_token,transaction_id,receipt_token,transaction_time,amount,user_role"

EDGE_FILES = {
    # header, a NULL token, padded fields, a quoted comma in the receipt
    "sales_20241118.csv": "\n".join([
        SALES_HEADER,
        "s1,t1,RCPT001,20241118T101500.000,$10.00,CASHIER",
        "s1,t2,NULL,20241118T111500.000,$11.00,CASHIER",
        "  s2 , t3 , RCPT003 , 2024-11-18 12:00:00 , $12.50 , MANAGER ",
        's2,t4,"RC,PT4",2024-11-18T13:00:00,$13.00,null',
        "s3,t5,RCPT005,NOT_A_TIMESTAMP,$5.00,CASHIER",
        "s3,t6,AB,20241118T140000.000,$6.00,CASHIER",
        "s3,t7,RCPT007,20241118T150000.000,NOT_MONEY,CASHIER",
        "",
    ]),
    # no header; short row, long row, empty field, header-like line in the middle
    "sales_20241119.csv": "\n".join([
        "s1,t1,RCPT001,20241119T090000.000,$20.00,CASHIER",
        "s4,t8,RCPT008",
        "s4,t9,RCPT009,20241119T100000.000,$9.00,CASHIER,EXTRA,MORE",
        ",t10,RCPT010,20241119T100000.000,$9.00,CASHIER",
        SALES_HEADER,
        "s5,t11,RCPT011,20241119T110000.000,$30.00,CASHIER",
        "",
    ]),
    # second delivery for the same date: re-sends t11 with a new amount
    "sales_20241119_2.csv": "s5,t11,RCPT011,20241119T110000.000,$31.00,CASHIER\n",
    "stores_20241118.csv": "store_group,store_token,store_name\n0000000A,s1,Store 1\n0000000B,s2,Store 2\n",
    "stores_20241119.csv": "0000000A,s1,Store 1 Renamed\n0000000B,s2,Store 2\n0000000C,s3,Null\n,s4,Store 4\n",
    "sales_20241120.csv": "",  # empty file
    "notes_20241119.csv": "not,a,feed\n",  # unknown prefix: ignored
    "readme.txt": "ignored\n",
}


def write_inbox(folder: str, files: dict[str, str] = EDGE_FILES) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)
    return folder
