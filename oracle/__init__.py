"""DuckDB SQL for every registered query.

The SQL spells the results out period by period, with one filtered aggregate per measure and one
join per period, while the Spark plans collapse the periods into few passes: agreement of the two
checks that the collapse is exact.
"""

from oracle.statements import oracle_statements

__all__ = ["oracle_statements"]
