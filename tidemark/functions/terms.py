"""Loan, account and client attributes as expressions over a numeric client id.

Loan amounts are powers of ten by id; every other rule is a modulus.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import band, by_remainder, first_divisor, padded, pick

# --- fixed values: code lists of the lending feed -------------------------
STATES = ["MH", "DL", "KA", "TN", "GJ", "UP", "WB", "RJ", "MP", "AP"]
FIRST_NAMES = [
    "Aarav", "Priya", "Rahul", "Sunita", "Vikram", "Anjali", "Ravi",
    "Meena", "Suresh", "Pooja", "Amit", "Kavita", "Deepak", "Nisha",
]
LAST_NAMES = [
    "Sharma", "Patel", "Singh", "Kumar", "Gupta", "Joshi", "Mehta",
    "Shah", "Verma", "Yadav", "Nair", "Reddy", "Das", "Mishra",
]
PAYMENT_MODES = ["NEFT", "RTGS", "IMPS", "CASH", "CHEQUE", "UPI", "DD"]
PRIMARY_PRODUCTS = ["PL001", "PL002", "HL001", "HL002", "GL001"]
SECONDARY_PRODUCTS = ["GL001", "BL001", "PL002"]
CLIENT_TYPE_RULES = [(10, "CORPORATE"), (5, "SME")]
CLIENT_TYPE_DEFAULT = "INDIVIDUAL"
ACCOUNT_STATUS_RULES = [(50, "CLOSED"), (25, "DORMANT"), (15, "FROZEN")]
ACCOUNT_STATUS_DEFAULT = "ACTIVE"
LOAN_STATUS_BANDS = [(60, "ACTIVE"), (80, "CLOSED"), (90, "NPA"), (95, "WRITTEN_OFF")]
LOAN_STATUS_DEFAULT = "RESTRUCTURED"
FREQUENCY_RULES = [(4, 0, "QUARTERLY"), (4, 1, "WEEKLY")]
FREQUENCY_DEFAULT = "MONTHLY"
REPAYMENT_RULES = [(3, 0, "BULLET"), (3, 1, "INTEREST_ONLY")]
REPAYMENT_DEFAULT = "EMI"
FEED_INSTALLMENTS = 36
DISBURSED_SHARE = 0.95
LAST_NAME_SHIFT = 7
SECONDARY_PRODUCT_SHIFT = 3
YEAR_DAYS = 365
LEAST_AGE = 18
AGE_YEARS = 57
BALANCE_BASE, BALANCE_STEPS = 3, 25
SANCTION_BASE, SANCTION_STEPS = 4, 20
AMOUNT_CYCLE = 100
RATE_BASE, RATE_CYCLE, RATE_STEPS = 8, 120, 10
TENURE_CYCLE, TENURE_BASE = 360, 12
USER_CYCLE, FUND_CYCLE = 100, 10
# --------------------------------------------------------------------------


def client_name(number: Column) -> Column:
    return F.concat_ws(" ", pick(FIRST_NAMES, number), pick(LAST_NAMES, number + LAST_NAME_SHIFT))


def client_type(number: Column) -> Column:
    return first_divisor(number, CLIENT_TYPE_RULES, CLIENT_TYPE_DEFAULT)


def birth_date(number: Column, today: Column) -> Column:
    """Between 18 and 75 years of 365 days before ``today``."""
    return F.date_sub(today, (number % (AGE_YEARS * YEAR_DAYS) + LEAST_AGE * YEAR_DAYS).cast("int"))


def user_code(number: Column) -> Column:
    return F.concat(F.lit("USER"), padded(number % USER_CYCLE + 1, 4))


def fund_code(number: Column) -> Column:
    return F.concat(F.lit("FUND"), padded(number % FUND_CYCLE + 1, 3))


def account_status(number: Column) -> Column:
    return first_divisor(number, ACCOUNT_STATUS_RULES, ACCOUNT_STATUS_DEFAULT)


def product_code(number: Column, slot: Column) -> Column:
    return F.when(slot == 1, pick(PRIMARY_PRODUCTS, number)).otherwise(
        pick(SECONDARY_PRODUCTS, number + SECONDARY_PRODUCT_SHIFT)
    )


def balance(number: Column) -> Column:
    return _power_of_ten(BALANCE_BASE, number, BALANCE_STEPS)


def sanction(number: Column) -> Column:
    return _power_of_ten(SANCTION_BASE, number, SANCTION_STEPS)


def _power_of_ten(base: int, number: Column, steps: int) -> Column:
    return F.round(F.pow(F.lit(10.0), base + (number % AMOUNT_CYCLE) / steps), 2)


def loan_status(number: Column) -> Column:
    return band(number % AMOUNT_CYCLE, LOAN_STATUS_BANDS, LOAN_STATUS_DEFAULT)


def interest_rate(number: Column) -> Column:
    """Yearly percent, 8.0 to 19.9."""
    return F.round(RATE_BASE + (number % RATE_CYCLE) / RATE_STEPS, 2)


def tenure_months(number: Column) -> Column:
    return (number % TENURE_CYCLE + TENURE_BASE).cast("int")


def frequency(number: Column) -> Column:
    return by_remainder(number, FREQUENCY_RULES, FREQUENCY_DEFAULT)


def repayment_type(number: Column) -> Column:
    return by_remainder(number, REPAYMENT_RULES, REPAYMENT_DEFAULT)
