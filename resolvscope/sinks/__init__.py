"""Writers. All of them leave the same table when an interval is written again."""
