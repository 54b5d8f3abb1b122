"""The data model's transforms: silver cleaning, gold KPIs, analytic queries, the whole run."""
