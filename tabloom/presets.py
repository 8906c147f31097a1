"""The bank-contacts table (public UCI "Bank Marketing" data): schema and customary roles."""

from __future__ import annotations

from tabloom.roles import Roles, table_schema

# Column names, order and types of the table.
BANK_CONTACTS_COLUMNS = {
    "age": "double",
    "job": "string",
    "marital": "string",
    "education": "string",
    "defaulted": "string",
    "housing": "string",
    "loan": "string",
    "contact_no": "string",
    "month_name": "string",
    "day_of_week": "string",
    "duration": "double",
    "campaign": "double",
    "pdays": "double",
    "previous": "double",
    "poutcome": "string",
    "emp_var_rate": "double",
    "cons_price_idx": "double",
    "cons_conf_idx": "double",
    "euribor3m": "double",
    "nr_employed": "double",
    "y": "string",
}
BANK_CONTACTS_SCHEMA = table_schema(BANK_CONTACTS_COLUMNS)

# ``duration`` is only known after a call has ended. Leave it out of a model that is to predict.
BANK_CONTACTS_ROLES = Roles(
    label="y",
    negative="no",
    positive="yes",
    numeric=("age", "duration", "pdays", "emp_var_rate", "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed"),
    categorical=("job", "marital", "education", "defaulted", "housing", "loan", "day_of_week", "poutcome"),
)
