"""weftline: panel (date x instrument) analytics declared as Spark plans."""
