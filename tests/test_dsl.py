"""The language: what compiles, what it becomes, and what is an error."""

import pytest

from kinetrail.plans import dsl, matcher
from kinetrail.plans.dsl import ScenarioError, compile_text
from kinetrail.units import Quantity


def scenario(body, fields="a: vehicle\n    b: vehicle"):
    return f"scenario top:\n    path: path\n    path.min_lanes(2)\n    {fields}\n    do {body}\n"


def call(line, *modifiers):
    with_ = " with:\n" + "".join(f"            {m}\n" for m in modifiers) if modifiers else ""
    return compile_text(scenario(f"parallel(duration: [1s..2s]):\n        a.{line}{with_}"))


def only(p):
    return p.blocks()[0].children[0]


CROSSING = scenario("serial:\n        near: parallel(duration: [2s..9s]):\n            a.drive(path) with:\n                speed([5kph..150kph])\n            b.cross(path) with:\n                speed([1kph..25kph])\n                lane(same_as: a, at: end)\n                position([1m..15m], ahead_of: a, at: end)", "a: vehicle\n    b: person")
LANES = scenario("serial:\n        lanes: parallel(duration: [4s..9s]):\n            a.drive(path) with:\n                lane(-1, at: start)\n                keep_lane()\n            b.drive(path) with:\n                position([5m..50m], ahead_of: a, at: start)\n                change_lane(1, side: left)\n                lane(same_as: a, at: end)")
BRAKING = scenario("serial:\n        brake: parallel(duration: [4s..9s]):\n            b.drive() with:\n                speed([40kph..60kph], at: start)\n                acceleration([-6mpss..-2mpss], at: end)\n            a.drive() with:\n                lane(same_as: b, at: start)\n                position([12m..40m], behind: b, at: start)\n                until rise(a.time_to_collision(reference: b) < 5s)")


@pytest.mark.parametrize("text", [CROSSING, LANES, BRAKING])
def test_published_shapes_compile(text):
    p = compile_text(text)
    assert p.errors == [] and p.min_lanes == 2 and len(p.blocks()) == 1


def test_paths_and_names_of_arguments():
    assert only(compile_text(CROSSING)).args == {"route": "path"}
    assert only(call("cross(path, speed: [1kph..25kph], side: left)")).args["side"] == "left"
    assert only(call("change_lane(2, left)")).args == {"num_of_lanes": Quantity(2, 2), "side": "left", "reference": "a"}
    assert only(call("change_lane(target: -1)")).args["target"] == Quantity(-1, -1)
    assert only(call("assign_speed(speed: 10mps)")).args["target"].lo == 10
    assert only(call("keep_space_gap(b)")).args == {"reference": "b", "direction": "longitudinal"}
    assert only(call("drive(5s)")).args["duration"].lo == 5
    assert only(call("assign_position(odr_point(road: '1', lane: -2, s: 10m, t: 0.5m))")).args["odr_point"]["s"].lo == 10
    (name, args, _), = only(call("drive()", "lane(right_of: b)")).modifiers
    assert (name, args) == ("lane", {"side_of": "b", "side": "right"})
    (name, args, _), = only(call("drive()", "lane(2, from: left)")).modifiers
    assert args == {"lane": Quantity(2, 2), "side": "left"}
    assert only(call("drive()", "position(ahead_of: b)")).modifiers[0][1] == {"ahead_of": "b", "at": "start"}
    assert only(call("drive()", "change_lane(side: left)")).modifiers[0][1]["lane"] == Quantity(1, 1)


@pytest.mark.parametrize("line, modifiers, wrong", [
    ("fly()", (), "unknown action"), ("change_space_gap(5m)", (), "needs direction"), ("change_lane(1)", (), "one of side, target"), ("assign_speed(5m)", (), "needs a speed"), ("assign_position()", (), "one of position"),
    ("drive()", ("speed(5m)",), "needs a speed"), ("drive()", ("position(5m)",), "one of ahead_of, behind"), ("drive()", ("position(5m, ahead_of: c)",), "not a role"), ("drive()", ("lane(at: start)",), "lane or same_as or side_of"),
    ("drive()", ("speed(5mps, at: noon)",), "can't be"), ("drive()", ("hover()",), "unknown modifier"), ("drive()", ("keep_lane(1)",), "too many arguments"), ("drive()", ("speed(5mps, colour: 1)",), "no argument"),
])
def test_errors_are_collected(line, modifiers, wrong):
    p = call(line, *modifiers)
    assert any(wrong in e for e in p.errors), p.errors
    assert all(e.startswith("line ") for e in p.errors)


@pytest.mark.parametrize("text, wrong", [
    ("scenario top:\n    a: vehicle\n", "no scenario"), ("scenario top:\n    do serial:\n        a.drive(\n", "line"), ("banana top:\n", "unsupported statement"), (scenario("parallel(duration: [5s..2s]):\n        a.drive()"), "lower end first"),
    (scenario("parallel(duration: [5s..2m]):\n        a.drive()"), "one dimension"), (scenario("parallel(duration: 5parsec):\n        a.drive()"), "unknown unit"), (scenario("parallel:\n        a.drive(x: 1, x: 2)"), "given twice"),
    (scenario("parallel(duration: [5s..b]):\n        a.drive()"), "two numbers"), ("scenario top:\n    a: vehicle\n  do serial:\n        a.drive()\n", "fits no block"), (scenario("parallel(duration: 5s / 0s):\n        a.drive()"), "division by zero"),
])
def test_errors_that_stop(text, wrong):
    with pytest.raises(ScenarioError, match=wrong):
        compile_text(text)


def test_expressions():
    def value(text):
        return compile_text(scenario(f"serial:\n        wait {text}\n        a.drive()")).body.children[0].value

    assert value("1 + 2 * 3 == 7") == {"op": "==", "left": Quantity(7, 7), "right": Quantity(7, 7)}
    assert value("7 % 4") == Quantity(3, 3) and value("-(2 + 1)") == Quantity(-3, -3)
    assert value("not x and y or z => w")["op"] == "=>"
    assert value("x in [1, 2, 3]")["right"] == [Quantity(i, i) for i in (1, 2, 3)]
    assert value("x ? 1 : 2")["op"] == "?" and value("f(1).as(int)") == {"op": "as", "left": {"call": "f", "on": None, "0": Quantity(1, 1)}, "type": "int"}
    assert value("lst[2]") == {"op": "[]", "left": "lst", "index": Quantity(2, 2)}
    assert value("@done if a.speed > 3mps")["event"] == "done" and value("elapsed([1s..2s])")["0"] == Quantity(1, 2, "time")
    assert value("a.speed > 3mps")["left"] == {"field": "speed", "on": "a"}


def test_statements_and_declarations():
    text = """
actor base
actor car inherits base
actor car inherits other
action base.go
action base.go.fast inherits base.go
modifier go.hurry
global most: speed = 10mps
enum side: [left, right]
struct pt:
    x: length
scenario other.thing:
    z: car
scenario top:
    a: car
    keep(a.speed < 5mps)
    event done is rise(a.speed > 2mps)
    cover(a.speed)
    limit: speed = most
    do serial:
        first: parallel(duration: [1s..2s]):
            a.drive() with:
                speed([1mps..20mps])
            emit done
        wait elapsed(2s)
        call a.helper(x: 1)
        second: one_of(duration: [2s..3s]):
            a.drive()
            serial:
                a.drive() with:
                    speed(limit)
"""
    p = compile_text(text)
    assert p.errors == [] and len(p.repeated) == 1 and [b.label for b in p.blocks()] == ["first", "second"]
    assert [c.kind for c in p.body.children] == ["parallel", "wait", "call", "one_of"]
    inner = p.blocks()[1].children[1]
    assert inner.effective(inner.children).hi == 3 and inner.children[0].modifiers[0][1]["value"].lo == 10
    r = dsl.Registry(p)
    assert r.ancestors("car") == ["car", "base"] and r.actions_of("car", "go") == ["base.go"] and r.in_family("base.go.fast", "base.go") and not r.in_family("base.go", "base.go.fast")
    assert r.modifier("speed").names[0] == "value" and r.modifier("hurry") is None and r.applies("hurry", "base.go") and not r.applies("hurry", "base.stop") and r.applies("speed", "base.stop")
    assert dsl.outline(p).splitlines()[0] == "a: car" and "  first: parallel [1..2]" in dsl.outline(p).splitlines() and "      speed(value: 10)" in "\n".join(dsl.outline(p).splitlines()[-3:]) + "\n"


def test_durations():
    p = compile_text(scenario("serial(duration: [2s..6s]):\n        one: parallel:\n            a.drive(duration: [1s..2s])\n        two: parallel(duration: 3s):\n            a.drive()"))
    one, two = p.blocks()
    calls = one.children
    assert p.durations()["one"].hi == 6 and p.durations()["two"].lo == 3
    assert one.effective(calls, "prefer_block").hi == 6 and one.effective(calls, "prefer_call").hi == 2 and two.effective(two.children, "strict").lo == 3
    with pytest.raises(ScenarioError):
        one.effective(calls, "strict")
    with pytest.raises(ValueError):
        one.effective(calls, "any")


def test_until_keeps_other_conditions():
    p = call("drive()", "until rise(a.speed > 3mps)")
    assert p.errors == [] and isinstance(only(p).modifiers[0][1]["until"], dict)
    assert isinstance(only(call("drive()", "until rise(5s > a.time_to_collision(reference: b))")).modifiers[0][1]["until"], dsl.Until)


def test_imports(tmp_path):
    (tmp_path / "lib.osc").write_text("actor car\n")
    (tmp_path / "top.osc").write_text("import lib.osc\nimport lib.osc\n" + scenario("serial:\n        a.drive()", "a: car"))
    assert dsl.compile_file(str(tmp_path / "top.osc")).errors == []
    (tmp_path / "lib.osc").write_text("import top.osc\n")
    with pytest.raises(ScenarioError, match="cycle"):
        dsl.compile_file(str(tmp_path / "top.osc"))


FRAMES = "scene_id string, actor_id string, actor_type string, t int, present boolean, lane_id int, speed double, s double, t_lat double, num_lanes int"


def frames(spark, gap=()):
    return spark.createDataFrame([("s", a, "vehicle", t, True, -1, 10.0, 10.0 * t + off, 0.0, lanes) for a, off, lanes in (("x", 0, 2), ("y", 30, 2)) for t in range(30) if t not in gap], FRAMES)


@pytest.mark.parametrize("line, modifiers, wrong", [
    ("change_speed(5mps)", (), "has no plan"), ("drive()", ("until rise(a.speed > 3mps)",), "time to collision"), ("drive()", ("until rise(a.time_to_collision(reference: b) < 5s)",), "times to collision"), ("cross()", (), "the frames have no t_dot, yaw_delta"),
])
def test_what_has_no_plan_raises(spark, line, modifiers, wrong):
    p = call(line, *modifiers)
    with pytest.raises(ValueError, match=wrong):
        matcher.match(p, frames(spark))


def test_windows_do_not_span_missing_frames_and_lanes_filter(spark):
    p = call("drive()", "speed([5mps..20mps])")
    got = matcher.match(p, frames(spark, gap=(15,)))["block_0"].collect()
    assert {r.a for r in got} == {"x", "y"} and not any(r.t0 < 15 <= r.t0 + 9 for r in got) and len(got) == 2 * (6 + 5)
    three = frames(spark).selectExpr("* except(num_lanes)", "if(actor_id = 'x', 1, 2) as num_lanes")
    assert {r.a for r in matcher.match(p, three)["block_0"].collect()} == {"y"}


def test_two_conditions_of_a_kind_both_hold(spark):
    f = frames(spark)
    one = call("drive()", "distance([50m..95m])")
    both = call("drive()", "distance([50m..95m])", "distance([1km..2km])")
    assert matcher.match(one, f, matcher.Config(fps=5.0))["block_0"].count() > 0
    assert matcher.match(both, f, matcher.Config(fps=5.0))["block_0"].count() == 0
