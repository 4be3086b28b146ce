
from __future__ import annotations

# The order dates of three delivered files, and their rows.
DAYS = ["2023-08-04", "2023-08-07", "2023-08-08"]

CSV_ROWS = [
    "New Bistro,2023-08-04,2023-08-07,Baguette,15",
    "New Bistro,2023-08-04,2023-08-07,Whole Wheat Loaf,12",
    "New Bistro,2023-08-04,2023-08-07,White Loaf,10",
    "New Bistro,2023-08-04,2023-08-07,Croissant,30",
    "New Bistro,2023-08-04,2023-08-08,Baguette,12",
    "New Bistro,2023-08-04,2023-08-08,Whole Wheat Loaf,12",
    "New Bistro,2023-08-04,2023-08-08,White Loaf,10",
    "New Bistro,2023-08-04,2023-08-08,Croissant,20",
    "New Bistro,2023-08-07,2023-08-08,Baguette,12",
    "New Bistro,2023-08-07,2023-08-08,Whole Wheat Loaf,12",
    "New Bistro,2023-08-07,2023-08-08,White Loaf,10",
    "New Bistro,2023-08-07,2023-08-08,Croissant,20",
    "New Bistro,2023-08-07,2023-08-09,Baguette,9",
    "New Bistro,2023-08-07,2023-08-09,Whole Wheat Loaf,8",
    "New Bistro,2023-08-07,2023-08-09,White Loaf,10",
    "New Bistro,2023-08-07,2023-08-09,Croissant,24",
    "New Bistro,2023-08-08,2023-08-09,Baguette,9",
    "New Bistro,2023-08-08,2023-08-09,Whole Wheat Loaf,8",
    "New Bistro,2023-08-08,2023-08-09,White Loaf,10",
    "New Bistro,2023-08-08,2023-08-09,Croissant,24",
    "New Bistro,2023-08-08,2023-08-10,Baguette,15",
    "New Bistro,2023-08-08,2023-08-10,Whole Wheat Loaf,10",
    "New Bistro,2023-08-08,2023-08-10,White Loaf,11",
    "New Bistro,2023-08-08,2023-08-10,Croissant,36",
]

DOCUMENT = {
    "Customer": "Park Inn",
    "Order date": "2023-08-11",
    "Orders": [
        {
            "Delivery date": "2023-08-14",
            "Orders by day": [
                {"Baked good type": "English Muffin", "Quantity": 30},
                {"Baked good type": "Whole Wheat Loaf", "Quantity": 6},
                {"Baked good type": "White Loaf", "Quantity": 4},
                {"Baked good type": "Bagel", "Quantity": 25},
                {"Baked good type": "Croissant", "Quantity": 36},
            ],
        },
        {
            "Delivery date": "2023-08-15",
            "Orders by day": [
                {"Baked good type": "English Muffin", "Quantity": 26},
                {"Baked good type": "Whole Wheat Loaf", "Quantity": 4},
                {"Baked good type": "Bagel", "Quantity": 22},
                {"Baked good type": "Croissant", "Quantity": 30},
            ],
        },
    ],
}


def csv_name(order_date: str) -> str:
    return f"Orders_{order_date}.csv"


def csv_lines(order_date: str) -> list[str]:
    return [row for row in CSV_ROWS if row.split(",")[1] == order_date]
