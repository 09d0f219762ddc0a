from .text import address_line, notification_columns
from .dates import birth_year, parse_day
from .metrics import observed
from .tickets import confirmation_status, remaining_pct, ticket_tier

__all__ = ["address_line", "notification_columns", "birth_year", "parse_day",
           "confirmation_status", "remaining_pct", "ticket_tier", "observed"]
