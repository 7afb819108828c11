"""Job plans: the daily batch job and the registered queries."""
