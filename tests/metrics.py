"""Counters of a finished query's table scans."""


def scans(df):
    """The metrics of each Parquet scan after collecting ``df``."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if "Scan parquet" in name:
            metrics = node.metrics()
            found.append({k: metrics.apply(k).value() for k in ("numFiles", "numOutputRows", "filesSize")})
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return found


def files_read(df):
    return sum(s["numFiles"] for s in scans(df))


def rows_read(df):
    return sum(s["numOutputRows"] for s in scans(df))


def walk_metrics(df, name, metric):
    """One metric of every operator of a collected query whose name starts so; rows of its child where it has none itself."""
    df.collect()
    found = []

    def value(node):
        metrics = node.metrics()
        return metrics.apply(metric).value() if metrics.contains(metric) else None

    def walk(node):
        kind = node.nodeName()
        if kind.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if kind.endswith("QueryStage"):
            return walk(node.plan())
        if kind.startswith(name):
            below = node
            while value(below) is None and below.children().size():
                below = below.children().apply(0)
                if below.nodeName().endswith("QueryStage"):
                    below = below.plan()
            found.append(value(below))
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        return None

    walk(df._jdf.queryExecution().executedPlan())
    return [v for v in found if v is not None]
