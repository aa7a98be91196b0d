"""tierline: a layered warehouse (RAW, STAGE, ODS, DDS, DM) expressed as Spark DataFrame operators."""
