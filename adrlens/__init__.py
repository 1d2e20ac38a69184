"""Drug-safety analytics on spontaneous adverse-event reports, as Spark DataFrame operators."""
